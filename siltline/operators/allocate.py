"""Group sums, shares of group totals and pro-rata apportionment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.functions.numbers import or_default, ratio
from siltline.operators.joins import group_join


def sum_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """``sums`` maps an output column to the column it adds up."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(out) for out, c in sums.items()])


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _part(weight: str, total: str) -> Column:
    """Exact sums are divided as doubles: a quotient of decimals keeps fewer digits."""
    return ratio(F.col(weight).cast("double"), F.col(total).cast("double"))


def partition_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Every row with the sum of ``value`` over its key; rows with a NULL key form a group of their own.

    The same result as a sum over an unordered window, but a group is never gathered in one task.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias(out), F.count("*").alias("_rows"))
    return group_join(df, totals, keys, "_rows", null_safe=True)


def share_of_total(
    df: DataFrame, keys: Sequence[str], weight: str, share: str = "share", total: str = "group_total"
) -> DataFrame:
    """Every row with its group's total and its part of it. Rows with a NULL key are dropped, as an
    inner join of the detail with its totals drops them; the share of a zero total is NULL."""
    kept = _keyed(df, keys)
    totals = kept.groupBy(*keys).agg(F.sum(weight).alias(total), F.count("*").alias("_rows"))
    return group_join(kept, totals, keys, "_rows").withColumn(share, _part(weight, total))


def left_with_default(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left equi-join; the columns in ``defaults`` take their default where the right side has no row."""
    joined = left.join(right, list(keys), "left")
    return joined.withColumns({c: or_default(c, v) for c, v in defaults.items()})


def apportion(
    detail: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    weight: str,
    measure: str,
    out: str = "allocated",
    total_out: str = "total",
) -> DataFrame:
    """Spread a coarse measure over finer rows in proportion to a weight.

    ``detail`` has one row per finest key and is read twice, so a costly one should be settled before.
    ``totals`` may have several rows per key; they are added up first. Both sides meet once per group,
    before the detail rows are touched, so the detail is joined a single time. Groups without a total
    get 0; groups of zero or unknown weight get NULL.
    """
    kept = _keyed(detail, keys)
    weights = kept.groupBy(*keys).agg(F.sum(weight).alias("_weight"), F.count("*").alias("_rows"))
    coarse = totals.groupBy(*keys).agg(F.sum(measure).alias(total_out))
    groups = left_with_default(weights, coarse, keys, {total_out: 0})
    joined = group_join(kept, groups, keys, "_rows")
    part = _part(weight, "_weight") * F.col(total_out).cast("double")
    return joined.select(*detail.columns, part.alias(out), total_out)


def unallocated(detail: DataFrame, totals: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """The coarse totals that no detail row takes up."""
    coarse = totals.groupBy(*keys).agg(F.sum(measure).alias(measure))
    return coarse.join(detail.select(*keys).distinct(), list(keys), "left_anti")
