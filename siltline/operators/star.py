"""Star schema: date dimension and surrogate key lookup."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.functions.dates import calendar_columns
from siltline.operators.dedup import first_per_key
from siltline.session import settle


def date_spine(spark: SparkSession, start: date, end: date, out: str = "date_day") -> DataFrame:
    """One row per day from ``start`` up to and not including ``end``."""
    days = spark.range((end - start).days)
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(out))


def spine_of(df: DataFrame, date_column: str, out: str = "date_day") -> DataFrame:
    """One row per day between the first and the last date of a frame, both included."""
    ends = df.agg(F.min(date_column).alias("_lo"), F.max(date_column).alias("_hi")).where(F.col("_lo").isNotNull())
    return ends.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(out))


def date_dimension(spine: DataFrame, day: str = "date_day") -> DataFrame:
    return spine.select(F.col(day).alias("date_key"), *[c.alias(n) for n, c in calendar_columns(day).items()])


@dataclass(frozen=True)
class Lookup:
    """One dimension of a fact: ``fact_column`` is matched with ``natural``, ``key`` is brought in.

    ``duplicates`` says what happens when a natural value has several keys: ``fan_out`` repeats the
    fact row, ``first`` takes the smallest key, ``error`` fails the job.
    """

    dimension: DataFrame
    fact_column: str
    natural: str
    key: str
    duplicates: str = "error"


def _unique(lookup: Lookup) -> DataFrame:
    side = lookup.dimension.select(F.col(lookup.natural).alias("_natural"), F.col(lookup.key).alias(lookup.key))
    if lookup.duplicates == "fan_out":
        return side
    if lookup.duplicates == "first":
        return first_per_key(side, ["_natural"], [lookup.key])
    grouped = side.groupBy("_natural").agg(F.count("*").alias("_n"), F.min(lookup.key).alias(lookup.key))
    message = F.concat(F.lit(f"{lookup.natural} is not unique: "), F.col("_natural").cast("string"))
    checked = F.when(F.col("_n") == 1, F.col(lookup.key)).otherwise(F.raise_error(message))
    return grouped.where(F.col("_natural").isNotNull()).select("_natural", checked.alias(lookup.key))


def lookup_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join the surrogate keys of several dimensions; a miss gives a NULL key.

    Each dimension's (natural value, key) pairs are settled, so that a repeated value is found before the
    fact is touched and the planner knows their size. No side is hinted: a table below Spark's threshold is
    broadcast; a larger one takes a sort-merge join of two plain shuffles, in which adaptive execution splits
    the rows of a frequent fact value over several tasks.
    """
    result = fact
    for lookup in lookups:
        side = settle(_unique(lookup), "lookup")
        joined = result.join(side, F.col(lookup.fact_column) == F.col("_natural"), "left")
        result = joined.drop("_natural")
    return result


def first_of_year(dimension: DataFrame) -> DataFrame:
    """The 1 January rows of a date dimension: (date_key, year), one per year."""
    key = F.col("date_key")
    return dimension.where((F.month(key) == 1) & (F.dayofmonth(key) == 1)).select("date_key", "year")
