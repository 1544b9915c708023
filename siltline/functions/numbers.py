"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, NULL where the denominator is zero or NULL."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def or_default(c: str | Column, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))
