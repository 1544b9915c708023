"""Rank, change over time and correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def change_by_period(df: DataFrame, keys: Sequence[str], period: str, value: str, out: str = "change") -> DataFrame:
    """Difference of ``value`` to the row before it in ``period`` order, per key.

    Meant for frames that hold one row per key and period, where the calendar bounds the rows of a key.
    """
    window = Window.partitionBy(*keys).orderBy(period)
    return df.withColumn(out, F.col(value) - F.lag(value).over(window))


def top_ranked(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int, rank_column: str = "rank"
) -> DataFrame:
    """The rows of rank ``k`` or better per key, ties included. Cut in the map tasks before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank_column, F.rank().over(window)).where(F.col(rank_column) <= k)


def correlation_by(df: DataFrame, keys: Sequence[str], x: str, y: str, out: str = "correlation") -> DataFrame:
    return df.groupBy(*keys).agg(F.corr(x, y).alias(out), F.count("*").alias("n"))
