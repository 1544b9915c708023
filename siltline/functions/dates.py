"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_year_month(df: DataFrame, date_column: str, month: bool = True) -> DataFrame:
    parts = {"year": F.year(date_column)}
    if month:
        parts["month"] = F.month(date_column)
    return df.withColumns(parts)


def year_quarter(c: str | Column) -> Column:
    return F.concat(F.year(_col(c)).cast("string"), F.lit("-Q"), F.quarter(_col(c)).cast("string"))


def calendar_columns(c: str | Column) -> dict[str, Column]:
    """Year, quarter, month, ISO week and the year-quarter label of a date."""
    d = _col(c)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "week": F.weekofyear(d),
        "year_quarter": year_quarter(d),
    }
