"""Lenient casts: a value that does not parse becomes NULL and never fails the job, in ANSI mode too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_or_null(c: str | Column, fmt: str | None = None) -> Column:
    return F.try_to_date(_col(c), fmt) if fmt else _col(c).try_cast("date")


def to_decimal_or_null(c: str | Column, precision: int, scale: int) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def to_int_or_null(c: str | Column) -> Column:
    """Reads ``14`` and ``14.0`` alike; fractions are cut, NaN and out-of-range values become NULL."""
    return _col(c).try_cast("double").try_cast("int")


def to_double_or_null(c: str | Column) -> Column:
    return _col(c).try_cast("double")
