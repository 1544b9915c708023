"""Row rules: filter by them, or route rejected rows with the names of the rules they break."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.functions.text import is_blank

REASONS = "reject_reasons"


@dataclass(frozen=True)
class Rule:
    """A named condition a row has to meet. A condition that evaluates to NULL counts as broken.

    The condition is a function without arguments, so that rules can be stated before a session exists.
    """

    name: str
    condition: Callable[[], Column]

    @property
    def met(self) -> Column:
        return F.coalesce(self.condition(), F.lit(False))


def required(column: str) -> Rule:
    return Rule(f"{column}_missing", lambda: F.col(column).isNotNull())


def not_blank(column: str) -> Rule:
    return Rule(f"{column}_blank", lambda: ~is_blank(column))


def positive(column: str) -> Rule:
    return Rule(f"{column}_not_positive", lambda: F.col(column) > 0)


def non_negative_or_null(column: str) -> Rule:
    return Rule(f"{column}_negative", lambda: F.col(column).isNull() | (F.col(column) >= 0))


def in_range(column: str, low, high) -> Rule:
    return Rule(f"{column}_out_of_range", lambda: F.col(column).between(low, high))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [r.condition() for r in rules]))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds the array of broken rules; empty for a valid row."""
    broken = F.array(*[F.when(~r.met, F.lit(r.name)) for r in rules])
    return df.withColumn(REASONS, F.array_compact(broken))


def route(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons). Both are filters over the same expression."""
    marked = with_reasons(df, rules)
    valid = marked.where(F.size(REASONS) == 0).drop(REASONS)
    return valid, marked.where(F.size(REASONS) > 0)


def reject_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(reason, n) in one aggregation without a shuffle by reason; rules that no row breaks count 0."""
    totals = df.agg(*[F.count_if(~r.met).alias(r.name) for r in rules])
    return totals.unpivot([], [F.col(f"`{r.name}`") for r in rules], "reason", "n")
