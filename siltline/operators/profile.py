"""Table profile: one aggregation over the table, one output row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_SAMPLE = "—"
SAMPLE_WIDTH = 80


def _parses(value: Column, kind: str) -> Column:
    return F.count(value.try_cast(kind))


def profile(df: DataFrame, order_by: Sequence[str], infer_text: bool = False) -> DataFrame:
    """(column, position, dtype, rows, columns, null_pct, sample) per column.

    ``sample`` is the first non-null value in ``order_by`` order, or a dash. With ``infer_text`` a text
    column whose values all parse as whole or decimal numbers is reported as bigint or double, which is
    what raw files are profiled for. All figures come from one aggregation, whatever the number of columns.
    """
    fields = df.dtypes
    order = F.struct(*[F.col(f"`{c}`") for c in order_by])
    measures = [F.count("*").alias("_rows")]
    for i, (name, dtype) in enumerate(fields):
        value = F.col(f"`{name}`")
        measures.append(F.count(value).alias(f"_n{i}"))
        measures.append(F.min_by(value.cast("string"), F.when(value.isNotNull(), order)).alias(f"_s{i}"))
        if infer_text and dtype == "string":
            measures.append(_parses(value, "bigint").alias(f"_b{i}"))
            measures.append(_parses(value, "double").alias(f"_d{i}"))
    totals = df.agg(*measures)
    lines = []
    for i, (name, dtype) in enumerate(fields):
        filled, rows = F.col(f"_n{i}"), F.col("_rows")
        kind = F.lit(dtype)
        if infer_text and dtype == "string":
            numeric = F.when(filled == F.col(f"_b{i}"), "bigint").when(filled == F.col(f"_d{i}"), "double")
            kind = F.when(filled > 0, numeric.otherwise("string")).otherwise("string")
        lines.append(F.struct(
            F.lit(name).alias("column"),
            F.lit(i + 1).alias("position"),
            kind.alias("dtype"),
            rows.alias("rows"),
            F.lit(len(fields)).alias("columns"),
            F.when(rows > 0, F.round((rows - filled) * 100.0 / rows, 1)).alias("null_pct"),
            F.coalesce(F.col(f"_s{i}"), F.lit(NO_SAMPLE)).alias("sample"),
        ))
    return totals.select(F.inline(F.array(*lines)))


def head(df: DataFrame, order_by: Sequence[str], n: int = 3) -> DataFrame:
    """The first rows in a stated order; a top-n, not a sort of the table."""
    return df.orderBy(*order_by).limit(n)


def table_cell(c: str | Column, width: int = SAMPLE_WIDTH) -> Column:
    """Text for a Markdown table: bars are escaped first and the result is cut to ``width`` after that."""
    value = F.col(c) if isinstance(c, str) else c
    return F.substring(F.replace(value, F.lit("|"), F.lit("\\|")), 1, width)


def report_lines(profiled: DataFrame) -> DataFrame:
    """One Markdown table line per profiled column."""
    line = F.concat(
        F.lit("| `"), F.col("column"), F.lit("` | "), F.col("dtype"), F.lit(" | "),
        F.col("null_pct").cast("string"), F.lit("% | "), table_cell("sample"), F.lit(" |"),
    )
    return profiled.select("position", line.alias("line"))
