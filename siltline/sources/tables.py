"""Typed, partitioned tables with idempotent partition overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.session import delete


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, in its order and with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together for few files, but let a large one stay on several tasks."""
    return df.hint("rebalance", *partition_by)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``; all others stay. A second run changes nothing."""
    writer = _spread(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    location: str,
    using: str = "parquet",
) -> None:
    """Create the table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using} "
        f"PARTITIONED BY ({parts}) LOCATION '{location}'"
    )


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str], using: str = "parquet") -> None:
    """Partition overwrite by table name. Catalogs of a table format have their own writer.

    ``insertInto`` looks at the session for the overwrite mode and not at writer options, so the mode is
    set for the time of the write.
    """
    if using == "iceberg":
        df.writeTo(name).overwritePartitions()
        return
    spark = df.sparkSession
    spread = _spread(df.select(*spark.table(name).columns), partition_by)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        spread.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def empty_partitions(values: DataFrame, path: str, table: str | None = None) -> None:
    """Removes the partitions that ``values`` names, a row each with the partition columns in their order. Partitions that are
    not there are passed over. The rows are those of a list of folders; they come to the driver, which removes them."""
    spark = values.sparkSession
    quoted = lambda v: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)
    for row in values.collect():
        if table:
            spec = ", ".join(f"`{c}` = {quoted(v)}" for c, v in row.asDict().items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        delete(spark, path + "".join(f"/{c}={v}" for c, v in row.asDict().items()))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or an empty frame of the schema where nothing was written yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
