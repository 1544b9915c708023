"""Stored history of a slowly changing dimension.

Each run has a folder ``run=<time>`` with the rows that are open after it (``open``) and those that it closed
(``closed``), and a marker that is written last; a folder without the marker does not count. A run reads the open rows
of the run before it. The last run can be repeated and then replaces all that it wrote; a run that is older than the
last one is refused. Open rows are kept for the last two runs, all that a repeat needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.operators import scd
from siltline.session import delete, hadoop_path, settle

RUN_FORMAT = "%Y%m%dT%H%M%S%f"
MARKER = "_DONE"


def _runs(spark: SparkSession, root: str) -> list[str]:
    """Finished runs, oldest first, by their markers: a listing, no scan."""
    fs, pattern = hadoop_path(spark, f"{root}/run=*/{MARKER}")
    found = fs.globStatus(pattern)
    return sorted(f.getPath().getParent().getName().removeprefix("run=") for f in found or ())


def advance(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime,
    names: scd.Validity = scd.Validity(),
) -> None:
    """One run: compare the input with the open rows of the run before and store what comes of it."""
    run, known = run_ts.strftime(RUN_FORMAT), _runs(spark, root)
    if known and run < known[-1]:
        raise ValueError(f"run {run} is older than the stored run {known[-1]}")
    earlier = [r for r in known if r < run]
    if earlier:
        open_rows = spark.read.parquet(f"{root}/run={earlier[-1]}/open")
        rows = scd.changes(open_rows, incoming, key, check_cols, run_ts, names)
    else:
        rows = scd.initial(incoming, key, check_cols, run_ts, names)
    rows = settle(rows, "run")
    folder = f"{root}/run={run}"
    delete(spark, folder)
    for state, wanted in (("open", F.col(names.end).isNull()), ("closed", F.col(names.end).isNotNull())):
        rows.where(wanted).hint("rebalance").write.parquet(f"{folder}/{state}")
    fs, marker = hadoop_path(spark, f"{folder}/{MARKER}")
    fs.create(marker, True).close()
    for old in earlier[:-1]:
        delete(spark, f"{root}/run={old}/open")


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All closed rows and the open rows of the last run."""
    runs = _runs(spark, root)
    return spark.read.parquet(f"{root}/run={runs[-1]}/open", *(f"{root}/run={r}/closed" for r in runs))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The open rows of the last run; nothing else is read."""
    return spark.read.parquet(f"{root}/run={_runs(spark, root)[-1]}/open")
