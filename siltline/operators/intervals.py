"""Date ranges: merged where they overlap or touch, and what they leave open."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _day(d: date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d)


def merged_ranges(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """``(keys, start, end)``: the ranges of days (both ends included) of each key, merged where they overlap or follow without a day between.

    Ranges without a key, start or end, and those that end before they start, count for nothing. Ranges with one start are reduced to the longest in the map
    tasks, so the windows hold one row for each key and day, however many ranges a key has.
    """
    whole = F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    longest = df.where(whole).groupBy(*keys, start).agg(F.max(end).alias(end))
    line = Window.partitionBy(*keys).orderBy(start)
    reach = F.max(end).over(line.rowsBetween(Window.unboundedPreceding, -1))
    begins = longest.withColumn("_new", (reach.isNull() | (F.col(start) > F.date_add(reach, 1))).cast("int"))
    numbered = begins.withColumn("_island", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def missing_ranges(
    wanted: DataFrame, covered: DataFrame, keys: Sequence[str], start: str, end: str, first: date | Column, last: date | Column
) -> DataFrame:
    """``(keys, start, end)``: the ranges between ``first`` and ``last`` (both included) that no range of ``covered`` takes in, for
    each key of ``wanted``; a key without a range misses all. Keys of ``covered`` that aren't wanted count for nothing.

    ``first`` and ``last`` may be columns of ``wanted``; of several rows of a key the widest range counts.
    """
    asked = wanted.groupBy(*keys).agg(F.min(_day(first)).alias("_first"), F.max(_day(last)).alias("_last")).where(F.col("_first") <= F.col("_last"))
    islands = merged_ranges(covered, keys, start, end).join(asked, list(keys)).where((F.col(end) >= F.col("_first")) & (F.col(start) <= F.col("_last")))
    edges = asked.select(*keys, F.date_sub("_first", 1).alias(start), F.date_sub("_first", 1).alias(end), "_first", "_last")
    parts = islands.select(*edges.columns).unionByName(edges)
    # an island that reaches back before the first day comes first, but the edge ends with the day before it
    parts = parts.withColumn(start, F.greatest(start, F.date_sub("_first", 1)))
    line = Window.partitionBy(*keys).orderBy(start, end)
    after = F.coalesce(F.date_sub(F.lead(start).over(line), 1), F.col("_last"))
    gaps = parts.select(*keys, F.date_add(end, 1).alias("_from"), after.alias("_to"))
    return gaps.where(F.col("_from") <= F.col("_to")).select(*keys, F.col("_from").alias(start), F.col("_to").alias(end))
