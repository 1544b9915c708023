"""Slowly changing dimension, type 2, by comparing columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.operators.dedup import first_per_key, latest_per_key


@dataclass(frozen=True)
class Validity:
    """Names of the interval columns: valid from (included) to (excluded), and the last write."""

    start: str = "valid_from"
    end: str = "valid_to"
    updated: str = "updated_at"

    @property
    def columns(self) -> list[str]:
        return [self.start, self.end, self.updated]


def _run(run_ts: datetime | Column) -> Column:
    """A plain datetime is read in the session time zone, not in that of the Python process."""
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts.isoformat(" ")).cast("timestamp")


def incoming_rows(df: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """One row per key; where a key comes with several versions, the smallest by ``check_cols`` is taken."""
    known = df.where(F.col(key).isNotNull()).select(key, *check_cols)
    return first_per_key(known, [key], check_cols)


def initial(df: DataFrame, key: str, check_cols: Sequence[str], run_ts: datetime | Column, names: Validity = Validity()) -> DataFrame:
    """History after the first run: one open row per key."""
    ts = _run(run_ts)
    return incoming_rows(df, key, check_cols).select(
        key,
        *check_cols,
        ts.alias(names.start),
        F.lit(None).cast("timestamp").alias(names.end),
        ts.alias(names.updated),
    )


def changes(
    open_rows: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | Column,
    names: Validity = Validity(),
) -> DataFrame:
    """What one run makes of the open rows: those that stay open, those it closes and those it opens.

    Both sides have one row per key, so the single full outer join has no hot key. A key that is absent
    from the input stays open. Columns are compared null-safely.
    """
    ts = _run(run_ts)
    fields = [key, *check_cols, *names.columns]
    old = open_rows.select(F.struct(*fields).alias("_old"), F.col(key).alias("_old_key"))
    fresh = incoming_rows(incoming, key, check_cols)
    new = fresh.select(
        F.struct(
            key,
            *check_cols,
            ts.alias(names.start),
            F.lit(None).cast("timestamp").alias(names.end),
            ts.alias(names.updated),
        ).alias("_new"),
        F.col(key).alias("_new_key"),
    )
    pair = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~F.col(f"_old.`{c}`").eqNullSafe(F.col(f"_new.`{c}`"))
    closed = F.struct(
        *[F.col(f"_old.`{c}`").alias(c) for c in [key, *check_cols, names.start]],
        ts.alias(names.end),
        ts.alias(names.updated),
    )
    outcome = (
        F.when(F.col("_new_key").isNull(), F.array("_old"))
        .when(F.col("_old_key").isNull(), F.array("_new"))
        .when(differs, F.array(closed, F.col("_new")))
        .otherwise(F.array("_old"))
    )
    return pair.select(F.inline(outcome)).select(*fields)


def snapshot(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | Column,
    names: Validity = Validity(),
) -> DataFrame:
    """The whole history after a run. Closed rows pass through and take no part in the join."""
    fields = [key, *check_cols, *names.columns]
    closed = history.where(F.col(names.end).isNotNull()).select(*fields)
    current = history.where(F.col(names.end).isNull())
    return changes(current, incoming, key, check_cols, run_ts, names).unionByName(closed)


def current_rows(history: DataFrame, key: str, names: Validity = Validity()) -> DataFrame:
    """The open row of each key; should there be several, the last written, then the largest by all columns."""
    rest = [c for c in history.columns if c not in (key, names.updated, names.end)]
    return latest_per_key(history.where(F.col(names.end).isNull()), [key], [names.updated, *rest])


def as_of(history: DataFrame, moment: datetime | Column, names: Validity = Validity()) -> DataFrame:
    """The rows that were valid at a moment."""
    t = _run(moment)
    return history.where((F.col(names.start) <= t) & (F.col(names.end).isNull() | (t < F.col(names.end))))
