"""Deduplication with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact(df: DataFrame) -> DataFrame:
    """One of each group of equal rows. Copies collapse in the map tasks, before the shuffle."""
    return df.dropDuplicates()


def distinct_values(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.select(*columns).distinct()


def _ordering(order_by: Sequence[str | Column], descending: bool) -> list[Column]:
    if not order_by:
        raise ValueError("order_by must name at least one column, or the survivor is arbitrary")
    flip = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    return [flip(F.col(c)) if isinstance(c, str) else c for c in order_by]


def top_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    n: int = 1,
    descending: bool = False,
    rank_column: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    The filter on the row number lets Spark cut every key to ``n`` rows per map task before the shuffle,
    so a key that holds most of the table sends few rows. Column objects keep their own direction.
    """
    number = rank_column or "_row_number"
    window = Window.partitionBy(*keys).orderBy(*_ordering(order_by, descending))
    ranked = df.withColumn(number, F.row_number().over(window)).where(F.col(number) <= n)
    return ranked if rank_column else ranked.drop(number)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    return top_per_key(df, keys, order_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    return top_per_key(df, keys, order_by, descending=True)
