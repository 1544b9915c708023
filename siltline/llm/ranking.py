"""Places and running sums in a seeded order, computed in bins of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bin, about; the number of bins follows from the number of rows.
BIN_ROWS = 500
#: Bins whose totals meet in one window.
FAN = 1000


def bins(rows: int) -> int:
    return max(1, -(-rows // BIN_ROWS))


def group_name(column: str) -> Column:
    """A non-null name of a group: nulls are a group of their own, after all others."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column)), F.lit("t"))


def seeded_key(seed: str, *parts: Column) -> Column:
    """32 hex digits that put rows in a seeded order; the parts are text."""
    return F.md5(F.concat_ws(":", F.lit(seed), *parts))


def share(key: Column) -> Column:
    """The first eight hex digits as a number from 0 to 1."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def running(df: DataFrame, keys: list[str], bin_name: str, order: list[str], what: str, out: str, fan: int = FAN) -> DataFrame:
    """``out``: the sum of ``what`` over the rows before each row, for each ``keys`` in the order of bin, ``order``.

    Windows run inside a bin of one group only; what lies in the bins before comes from a table of bin totals. Its bins
    are put in bins of ``fan`` in turn, so the only window over a whole group has one row for each ``fan`` bins.
    """
    own = [*keys, bin_name]
    totals = _before(df.groupBy(*own).agg(F.sum(what).alias("__sum")), keys, bin_name, fan)
    inside = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("__inside", F.coalesce(F.sum(what).over(inside), F.lit(0)))
    return placed.join(totals, own).withColumn(out, (F.col("__before") + F.col("__inside")).cast("long")).drop("__before", "__inside")


def _before(totals: DataFrame, keys: list[str], bin_name: str, fan: int) -> DataFrame:
    """``(keys, bin, __before)``: the sums of the bins before each bin of a group."""
    upto = lambda what, w: F.coalesce(F.sum(what).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    packed = totals.withColumn("__pack", F.floor(F.col(bin_name) / fan))
    packs = packed.groupBy(*keys, "__pack").agg(F.sum("__sum").alias("__pack_sum"))
    packs = packs.select(*keys, "__pack", upto("__pack_sum", Window.partitionBy(*keys).orderBy("__pack")).alias("__packs_before"))
    inner = packed.withColumn("__inner", upto("__sum", Window.partitionBy(*keys, "__pack").orderBy(bin_name)))
    return inner.join(packs, [*keys, "__pack"]).select(*keys, bin_name, (F.col("__packs_before") + F.col("__inner")).alias("__before"))
