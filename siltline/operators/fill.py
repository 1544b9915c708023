"""Readings with gaps to one row for each key and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltline.operators.dedup import first_per_key

#: Days of a range of one key that a window holds.
RANGE_DAYS = 366


def filled_days(df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], max_age: int, range_days: int = RANGE_DAYS) -> DataFrame:
    """``(keys, day, values, <value>_filled)``: each day from the first to the last reading of a key. A missing value is the last one before
    it, if that is at most ``max_age`` days old, and is marked as filled; else it is null.

    Rows without a key or day count for nothing; of several readings of a key and day the smallest by ``values`` counts (nulls
    first). Keys are cut into ranges of ``range_days``; the values that stand when a range begins are carried over from the
    ranges before by a window over one row per key and range, so no window holds more than a range of days.
    """
    whole = F.col(day).isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    spot = lambda d: F.floor(F.unix_date(d) / range_days).cast("long")
    readings = first_per_key(df.where(whole).select(*keys, F.col(day).cast("date").alias(day), *values), [*keys, day], list(values))
    states = [F.when(F.col(v).isNotNull(), F.struct(F.col(day).alias("day"), F.col(v).alias("value"))).alias(f"_s{i}") for i, v in enumerate(values)]
    readings = readings.select(*keys, day, *values, *states)

    ends = readings.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    spine = ends.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(day)).withColumn("_range", spot(F.col(day)))
    names = [f"_s{i}" for i in range(len(values))]
    lasts = readings.groupBy(*keys, spot(F.col(day)).alias("_range")).agg(*[F.max(s).alias(s) for s in names])
    ranges = ends.select(*keys, F.explode(F.sequence(spot(F.col("_lo")), spot(F.col("_hi")))).alias("_range")).join(lasts, [*keys, "_range"], "left")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    openings = ranges.select(*keys, "_range", *[F.last(s, ignorenulls=True).over(before).alias(f"_o{s}") for s in names])

    dense = spine.join(readings, [*keys, day], "left").join(openings, [*keys, "_range"])
    upto = Window.partitionBy(*keys, "_range").orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out, marks = [], []
    for v, s in zip(values, names, strict=True):
        standing = F.coalesce(F.last(s, ignorenulls=True).over(upto), F.col(f"_o{s}"))
        fresh = F.date_diff(F.col(day), standing["day"]) <= max_age
        out.append(F.when(fresh, standing["value"]).alias(v))
        marks.append((F.col(v).isNull() & F.coalesce(fresh, F.lit(False))).alias(f"{v}_filled"))
    return dense.select(*keys, day, *out, *marks)
