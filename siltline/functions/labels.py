"""Category labels: many values to one label, with a default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_of(c: str | Column, groups: Mapping[str, Sequence[str]], default: str | Column) -> Column:
    """Label whose value list holds ``c``. The lists are literals, so the result is one CASE over IN sets."""
    value, chain = _col(c), None
    for label, values in groups.items():
        hit = value.isin(*values)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if chain is None else chain.otherwise(fallback)


def label_by_keyword(c: str | Column, groups: Mapping[str, Sequence[str]], default: str | Column) -> Column:
    """As ``label_of``, but a value belongs to a label when it contains one of its words."""
    value, chain = _col(c), None
    for label, words in groups.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | value.contains(word)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if chain is None else chain.otherwise(fallback)


def renamed_value(c: str | Column, names: Mapping[str, str]) -> Column:
    """Value-to-value map; values without an entry stay as they are."""
    value, chain = _col(c), None
    for old, new in names.items():
        chain = F.when(value == old, new) if chain is None else chain.when(value == old, new)
    return value if chain is None else chain.otherwise(value)


def label_from_table(
    df: DataFrame, column: str, mapping: DataFrame, value: str, label: str, out: str, default: str
) -> DataFrame:
    """Label taken from a mapping table; of several labels of a value the smallest counts, so no row is repeated.

    The table may be of any size: no hint is set, so its measured size decides between a broadcast
    and a shuffled join.
    """
    side = mapping.groupBy(F.col(value).alias("_value")).agg(F.min(label).alias("_label"))
    joined = df.join(side, F.col(column) == F.col("_value"), "left")
    return joined.select(*df.columns, F.coalesce("_label", F.lit(default)).alias(out))
