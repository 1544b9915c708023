"""Data-quality tests. Each returns the failing rows; no row means the test passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures) of several not-null tests, from one pass over the table."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return totals.unpivot([], [F.col(f"`{c}`") for c in columns], "column", "failures")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of the non-null values that occur more than once."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counted.where("n > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """(value, n) of the non-null values outside the list."""
    outside = df.where(~F.col(column).isin(*values))
    return outside.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(value, n) of the child values without a parent row, with the number of child rows.

    Both sides are reduced to one row per value before they are joined, so a frequent value crosses the
    network once per map task. NULL child values are not looked at.
    """
    counted = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return counted.join(known, "value", "left_anti")


@dataclass(frozen=True)
class Check:
    """One line of a suite: ``kind`` is not_null, unique, accepted_values or relationships."""

    table: str
    column: str
    kind: str
    values: Sequence = ()
    parent: str = ""
    parent_column: str = ""


@dataclass
class Suite:
    checks: list[Check] = field(default_factory=list)

    def add(self, table: str, column: str, *kinds: str, **arguments) -> "Suite":
        self.checks += [Check(table, column, kind, **arguments) for kind in kinds]
        return self

    def run(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """(table_name, column, test, failures, status) of every check.

        Failures are null rows, repeated values, unknown values and child rows without a parent. Each table is read once:
        every row gives a line (check, value) for each check that has to look at it, also where the table is a
        parent, and all lines are counted together, combined in the map tasks. Rows that a not-null or accepted-values
        check has nothing against give no line. Values are compared by their text; a child value is put in the type of its
        parent first.
        """
        lines: dict[str, list[Column]] = {}
        for i, check in enumerate(self.checks):
            if check.kind not in KINDS:
                raise ValueError(f"unknown test {check.kind}")
            kind = tables[check.table].schema[check.column].dataType
            value = F.col(f"`{check.column}`")
            if check.kind == "relationships":
                parent = tables[check.parent].schema[check.parent_column].dataType
                own = lines.setdefault(check.parent, [])
                own.append(_line(i, F.col(f"`{check.parent_column}`").isNotNull(), _text(F.col(f"`{check.parent_column}`"), parent), 0))
                same = kind == parent
                text = _text(value, kind) if same else F.coalesce(_text(value.try_cast(parent), parent), _text(value, kind))
            else:
                text = F.lit(None).cast("string") if check.kind == "not_null" else _text(value, kind)
            looked_at = value.isNull() if check.kind == "not_null" else value.isNotNull()
            if check.kind == "accepted_values":
                looked_at &= ~value.isin(*check.values)
            lines.setdefault(check.table, []).append(_line(i, looked_at, text, 1))
        if not lines:
            raise ValueError("a suite without a check")
        read = [tables[t].select(F.explode(F.array_compact(F.array(*own))).alias("_l")).select("_l.*") for t, own in lines.items()]
        counted = reduce(DataFrame.unionByName, read).groupBy("check", "value").agg(F.sum("child").alias("n"), F.sum("parent").alias("known"))
        found = counted.groupBy("check").agg(
            F.sum("n").alias("not_null"), F.count_if(F.col("n") > 1).alias("unique"), F.count("*").alias("accepted_values"),
            F.sum(F.when(F.col("known") == 0, F.col("n")).otherwise(0)).alias("relationships"))
        spark = read[0].sparkSession
        asked = spark.createDataFrame([(i, c.table, c.column, c.kind) for i, c in enumerate(self.checks)], "check int, table_name string, column string, test string")
        failures = F.lit(None).cast("bigint")
        for kind in KINDS:
            failures = F.when(F.col("test") == kind, F.col(kind)).otherwise(failures)
        result = asked.join(found, "check", "left").withColumn("failures", F.coalesce(failures, F.lit(0)).cast("bigint"))
        return result.select("table_name", "column", "test", "failures", F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


KINDS = ("not_null", "unique", "accepted_values", "relationships")


def _text(value: Column, kind: T.DataType) -> Column:
    """The text by which a value is counted; both zeros of a floating number are one."""
    return (value + F.lit(0.0) if kind.typeName() in ("float", "double") else value).cast("string")


def _line(check: int, looked_at: Column, value: Column, child: int) -> Column:
    return F.when(looked_at, F.struct(F.lit(check).alias("check"), value.alias("value"), F.lit(child).alias("child"), F.lit(1 - child).alias("parent")))
