"""Group sums that follow a partitioned table batch by batch, without reading it again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.session import delete, hadoop_path
from siltline.sources.tables import overwrite_partitions, read_or_empty

ROWS, BATCH = "rows_in", "batch_id"


def signed_sums(new: DataFrame, old: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """What a batch changes: per group the sums of the new rows minus those of the rows that they replace, and the same for
    the number of rows. Added up in the map tasks; groups that stay as they are give a row of zeros, at most."""
    plus = new.select(*keys, *measures, F.lit(1).cast("bigint").alias(ROWS))
    minus = old.select(*keys, *[(-F.col(m)).alias(m) for m in measures], F.lit(-1).cast("bigint").alias(ROWS))
    return plus.unionByName(minus).groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures], F.sum(ROWS).alias(ROWS))


def _stored_schema(schema: T.StructType, keys: Sequence[str], measures: Sequence[str]) -> T.StructType:
    """Sums are kept as decimals, which add up to the same in any order; the scale is that of the measure."""
    kinds = {f.name: f.dataType for f in schema.fields}
    whole = ("byte", "short", "integer", "long")
    scale = {m: 0 if kinds[m].typeName() in whole else kinds[m].scale for m in measures}
    return T.StructType([T.StructField(k, kinds[k]) for k in keys] + [T.StructField(m, T.DecimalType(38, scale[m])) for m in measures]
                        + [T.StructField(ROWS, T.LongType()), T.StructField(BATCH, T.LongType())])


class Sums:
    """Sums of ``measures`` (whole numbers or decimals) by ``keys`` over a table that is stored at ``table``.

    ``partition_by`` are the partition columns of the table, which have to be among the keys, so a batch touches the stored
    sums of its own partitions only. Batches have growing numbers. Each stored partition carries the number of the last
    batch that it has taken, so a batch that is run again, after a loss or by mistake, changes nothing.
    """

    def __init__(self, spark: SparkSession, table: str, target: str, schema: T.StructType, keys: Sequence[str], measures: Sequence[str], partition_by: Sequence[str]):
        if lacking := [c for c in partition_by if c not in keys]:
            raise ValueError(f"partition columns that are no key: {', '.join(lacking)}")
        self.spark, self.table, self.target, self.schema = spark, table, target, schema
        self.keys, self.measures, self.partition_by = list(keys), list(measures), list(partition_by)
        self.stored = _stored_schema(schema, keys, measures)

    def read(self) -> DataFrame:
        """The sums as they stand; groups without a row are left out."""
        return read_or_empty(self.spark, f"{self.target}/sums", self.stored).where(F.col(ROWS) > 0).drop(BATCH)

    def _last_batches(self, stored: DataFrame) -> DataFrame:
        """The last batch of each stored partition: a row for each folder."""
        return stored.groupBy(*self.partition_by).agg(F.max(BATCH).alias("_last"))

    def _by_partition(self, df: DataFrame, partitions: DataFrame, how: str) -> DataFrame:
        on = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in self.partition_by]
        return df.join(partitions.select(*[F.col(c).alias(f"_t_{c}") for c in self.partition_by]).distinct(), on, how)

    def _touched(self, partitions: DataFrame, df: DataFrame) -> DataFrame:
        """Rows of ``df`` in the partitions that another frame has."""
        return self._by_partition(df, partitions, "left_semi")

    def _without(self, df: DataFrame, partitions: DataFrame) -> DataFrame:
        return self._by_partition(df, partitions, "left_anti")

    def replace(self, rows: DataFrame, batch_id: int) -> None:
        """Replaces the partitions of the table that ``rows`` has by ``rows``, and brings the sums up to date.

        The change is written first, under the number of the batch; a batch that broke off goes on with the change it wrote, even if
        the table has its new rows already. Then the table is overwritten, and then the sums. Partitions that a later batch has
        replaced since stay as they are.
        """
        stored = read_or_empty(self.spark, f"{self.target}/sums", self.stored)
        rows = self._without(rows, self._last_batches(stored).where(F.col("_last") > batch_id))
        change = f"{self.target}/changes/batch={batch_id}"
        fs, where = hadoop_path(self.spark, f"{change}/_SUCCESS")
        if not fs.exists(where):
            new = rows.select(*self.schema.names)
            old = self._touched(new.select(*self.partition_by), read_or_empty(self.spark, self.table, self.schema))
            signed_sums(new, old, self.keys, self.measures).write.mode("overwrite").parquet(change)
        overwrite_partitions(rows.select(*self.schema.names), self.table, self.partition_by)
        self.take(self.spark.read.parquet(change), batch_id)

    def take(self, change: DataFrame, batch_id: int) -> None:
        """Adds a written change to the stored sums of its partitions, except where they have taken it already."""
        stored = read_or_empty(self.spark, f"{self.target}/sums", self.stored)
        fresh = self._without(change, self._last_batches(stored).where(F.col("_last") >= batch_id))
        before = self._touched(fresh.select(*self.partition_by), stored)
        kinds = {f.name: f.dataType for f in self.stored.fields}
        both = before.drop(BATCH).unionByName(fresh.select(*self.keys, *[F.col(m).cast(kinds[m]).alias(m) for m in self.measures], ROWS))
        merged = both.groupBy(*self.keys).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in self.measures], F.sum(ROWS).alias(ROWS))
        staged = f"{self.target}/merged"
        merged.withColumn(BATCH, F.lit(batch_id).cast("bigint")).select(*self.stored.names).write.mode("overwrite").parquet(staged)
        overwrite_partitions(self.spark.read.schema(self.stored).parquet(staged), f"{self.target}/sums", self.partition_by)
        delete(self.spark, staged)
