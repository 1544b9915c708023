"""New raw files to a partitioned silver table, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.operators.dedup import first_per_key
from siltline.session import delete, scope, settle
from siltline.sources.raw_csv import read_raw_csv, with_position
from siltline.sources.tables import overwrite_partitions, read_or_empty


FILES = "path string, modificationTime timestamp, length long, content binary"


def _partition_name(columns: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def merge_first(stored: DataFrame, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """The stored rows of the partitions the batch touches, with the batch rows of unknown keys added.

    A key counts as known in whatever partition it is stored; for that only the key columns of the table are read.
    The touched partitions are a filter on partition columns alone; their number is that of folders, not of rows.
    Both sides hold a key once, so at most two rows of a key meet.
    """
    new = settle(batch.join(stored.select(*keys), list(keys), "left_anti").select(*batch.columns), "new")
    name = _partition_name(partition_by)
    touched = [r.p for r in new.select(name.alias("p")).distinct().collect()]
    return stored.where(name.isin(touched)).unionByName(first_per_key(new, keys, list(keys)))


def upsert_first(
    spark: SparkSession,
    batch: DataFrame,
    target: str,
    staging: str,
    schema: T.StructType,
    keys: Sequence[str],
    partition_by: Sequence[str],
) -> None:
    """Add a batch to the table at ``target``; a key that is stored already keeps its stored row.

    The merged partitions are written to ``staging`` first: a job that is run again after a loss never
    reads partitions it has half replaced. Running the same batch twice changes nothing, and nothing but the table
    stays behind.
    """
    with scope(spark):
        merged = merge_first(read_or_empty(spark, target, schema), batch, keys, partition_by)
        merged.write.mode("overwrite").parquet(staging)
        overwrite_partitions(spark.read.schema(schema).parquet(staging), target, partition_by)
        delete(spark, staging)


def run_available(
    spark: SparkSession,
    source: str,
    raw_schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    schema: T.StructType,
    keys: Sequence[str],
    partition_by: Sequence[str],
    checkpoint: str,
    max_files_per_batch: int | None = None,
    timeout: int | None = None,
    file_format: str = "csv",
) -> None:
    """Process the files that arrived since the last run, then stop.

    ``transform`` is the plain batch function of the silver table; it gets each micro-batch of ``drain_files`` with its position
    columns.
    """
    def take(rows: DataFrame, batch_id: int) -> None:
        upsert_first(rows.sparkSession, transform(rows), target, f"{checkpoint}/merged", schema, keys, partition_by)

    drain_files(spark, source, raw_schema, take, f"{checkpoint}/stream", max_files_per_batch, timeout, file_format)


def drain_files(
    spark: SparkSession,
    source: str,
    raw_schema: T.StructType,
    take: Callable[[DataFrame, int], None],
    checkpoint: str,
    max_files_per_batch: int | None = None,
    timeout: int | None = None,
    file_format: str = "csv",
) -> None:
    """Gives the files that arrived since the last run to ``take``, micro-batch by micro-batch, then stops.

    The checkpoint remembers processed files, so nothing is read twice. The stream is one of file names; each
    micro-batch reads its files as a batch job would, CSV by the header of each file, with position columns. A batch
    that broke off comes again under its number.
    """
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    files = reader.load(source).select("path")

    def handle(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        paths = sorted(r.path for r in batch.collect())
        if not paths:
            return
        if file_format == "csv":
            rows = read_raw_csv(own, paths, raw_schema.names, position=True)
        else:
            rows = with_position(own.read.format(file_format).schema(raw_schema).load(paths))
        take(rows, batch_id)

    query = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finish(query, timeout)


def finish(query, timeout: int | None) -> None:
    """Waits until all is done, or for so many seconds if a bound is given."""
    if timeout is None:
        query.awaitTermination()
        return
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout} s")
