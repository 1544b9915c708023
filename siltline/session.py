"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators count on; cluster sizing is left to the caller."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siltline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the folder that ``setCheckpointDir`` was given.

    As everywhere in Spark, a path without a file system is one of the default file system. Where neither is set, a session
    with all its threads in one process (``local`` or ``local[n]``) gets a folder of its own, any other the warehouse. A folder
    of the local file system that an executor does not see is refused: what is written there would be lost.
    """
    one_process = re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", ""))
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = _local_root() if one_process else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_siltline"
    fs, where = hadoop_path(spark, root)
    root = fs.makeQualified(where).toString().rstrip("/")
    if not one_process and fs.getUri().getScheme() == "file":
        _seen_by_executors(spark, spark.sparkContext.applicationId, root)
    return root


@functools.cache
def _seen_by_executors(spark: SparkSession, application: str, root: str) -> None:
    """An executor reads a file of the driver, once for each application and folder."""
    path = f"{root}/seen-{uuid.uuid4().hex}"
    fs, where = hadoop_path(spark, path)
    out = fs.create(where)
    out.writeBytes("seen\n")
    out.close()
    try:
        seen = spark.read.text(path).collect()
    except Exception as e:
        raise RuntimeError(f"executors do not see {root}: set spark.checkpoint.dir to a folder shared by driver and executors") from e
    finally:
        fs.delete(where, False)
    if [r[0] for r in seen] != ["seen"]:
        raise RuntimeError(f"executors do not see {root}: set spark.checkpoint.dir to a folder shared by driver and executors")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="siltline-")


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one job's written tables."""
    return f"{shared_root(spark)}/siltline/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    fs, where = hadoop_path(spark, path)
    fs.delete(where, True)


_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes what was settled inside when a job ends. For jobs that write their results, not for frames that are
    returned and read later."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def settle(df: DataFrame, label: str = "frame") -> DataFrame:
    """Write a frame to the shared folder and continue from the written table.

    For frames that several later steps read: they are computed once, a lost executor costs one read
    instead of the whole lineage, and the planner knows their size.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
