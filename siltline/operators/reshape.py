"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.session import settle


def drop_marked(df: DataFrame, marker: str) -> DataFrame:
    """Drop the columns whose name holds ``marker``. Looks at the schema only."""
    return df.drop(*[c for c in df.columns if marker in c])


def subtotal_heads(columns: Sequence[str], marker: str) -> set[str]:
    """What stands before the marker in the names of subtotal columns."""
    return {head for head, mark, _ in (c.partition(marker) for c in columns) if mark}


def cut_at_head(name: str, heads: set[str], unknown: str = "unknown") -> tuple[str, str]:
    """Walk the separators of a name from the right until what stands before one is a head."""
    at = name.rfind("_")
    while at > 0 and name[:at] not in heads:
        at = name.rfind("_", 0, at)
    return (name[:at], name[at + 1:]) if at > 0 else (unknown, name)


def to_long(df: DataFrame, ids: Sequence[str], name: str = "col", value: str = "raw_value") -> DataFrame:
    """Every column outside ``ids`` becomes one row per input row; a single pass over the input."""
    values = [F.col(f"`{c}`") for c in df.columns if c not in ids]
    return df.unpivot([F.col(f"`{c}`") for c in ids], values, name, value)


def unpivot_matrix(
    df: DataFrame,
    ids: Sequence[str],
    marker: str = "_total_",
    prefix: str = "province",
    rest: str = "country",
    value: str = "raw_value",
    exclude_prefixes: Sequence[str] = (),
) -> DataFrame:
    """Long form of a matrix whose column names are ``<prefix>_<rest>``.

    The prefixes are learned from the subtotal columns, which are then dropped. The name table that is
    broadcast has one row per column of the matrix, so the schema bounds its size.
    """
    heads = subtotal_heads(df.columns, marker)
    detail = drop_marked(df, marker)
    names = []
    for c in detail.columns:
        if c in ids:
            continue
        owner, remainder = cut_at_head(c, heads)
        if owner not in exclude_prefixes:
            names.append((c, owner, remainder))
    if not names:
        empty = [F.lit(None).cast("string").alias(c) for c in (prefix, rest, value)]
        return df.select(*ids, *empty).where(F.lit(False))
    kept = detail.select(*[f"`{c}`" for c in ids], *[f"`{c}`" for c, _, _ in names])
    table = df.sparkSession.createDataFrame(names, f"_name string, `{prefix}` string, `{rest}` string")
    long = to_long(kept, ids, "_name", value)
    return long.join(F.broadcast(table), "_name").select(*ids, prefix, rest, value)


def split_by_prefix(
    df: DataFrame,
    column: str,
    prefixes: DataFrame,
    prefix_column: str,
    out_prefix: str = "prefix",
    out_rest: str = "rest",
    separator: str = "_",
    unknown: str = "unknown",
) -> DataFrame:
    """Cut ``column`` after its longest known prefix, where the prefixes are data.

    Each distinct name offers the strings that end at one of its separators, and these meet the prefix
    table in an equi-join. Nothing is compared pair by pair, and repeated names are resolved once. The
    prefixes and the resolved names are settled: joined as a table of known size they are broadcast, or
    adaptive execution splits the rows of a frequent prefix or name.
    """
    names = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_name")).distinct()
    mark = F.lit(separator)
    without = F.replace(F.col("_name"), mark, F.lit(""))
    marks = ((F.length("_name") - F.length(without)) / len(separator)).cast("int")
    heads = F.transform(F.sequence(F.lit(1), marks), lambda n: F.call_function("substring_index", F.col("_name"), mark, n))
    offers = names.where(F.contains("_name", mark)).select("_name", F.explode(heads).alias("_prefix"))
    known = settle(prefixes.select(F.col(prefix_column).alias("_prefix")).distinct(), "prefixes")
    cuts = offers.join(known, "_prefix").groupBy("_name").agg(F.max(F.length("_prefix")).alias("_cut"))
    best = settle(cuts, "cuts")
    cut = F.col("_cut")
    name = F.col(column)
    return df.join(best, name == F.col("_name"), "left").select(
        *df.columns,
        F.when(name.isNotNull(), F.coalesce(F.substring(name, F.lit(1), cut), F.lit(unknown))).alias(out_prefix),
        F.coalesce(F.substring(name, cut + 1 + len(separator), F.length(name)), name).alias(out_rest),
    )


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The canonical columns in their fixed order."""
    return df.select(*columns)
