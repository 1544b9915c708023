"""Session settings, settled tables and word helpers that the operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.session import workspace

#: Shuffle files go when the job that made them ends; small Arrow batches, as one text can be very long.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_MIX_1, _MIX_2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(docs: DataFrame, name: str = "row") -> Column:
    """All columns of a frame as one struct, whatever their names."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias(name)


def rest_of(docs: DataFrame, *known: str) -> Column:
    """The columns other than those named, as text: an order for rows that are alike in the others."""
    rest = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c.lower() not in known]
    return F.to_json(F.struct(*rest)) if rest else F.lit("")


class Scratch:
    """Tables of one operator below the shared folder; ``drop`` removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self._n = prepare(spark), workspace(spark, label), 0
        self._paths: dict[int, str] = {}

    def save(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        self._keep = [*getattr(self, "_keep", []), out]
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := self._paths.pop(id(df), None):
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` in UTF-8; none for a null."""
    return text.encode().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix), element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX_1
        x = (x ^ (x >> np.uint64(27))) * _MIX_2
        return x ^ (x >> np.uint64(31))


def join_hash(a: np.ndarray, b: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of two neighbouring windows from theirs; each lane is an independent family."""
    with np.errstate(over="ignore"):
        return mix(mix(a + _STEP * np.uint64(2 * lane + 1)) + b * _STEP + np.uint64(lane))


def halves(length: int) -> list[int]:
    """Window lengths 1 .. length, each at most twice the one before: 35 gives 1 2 3 5 9 18 35."""
    out = [length]
    while out[0] > 1:
        out.insert(0, (out[0] + 1) // 2)
    return out


def extend_hash(h: np.ndarray, short: int, long: int, lane: int = 0) -> np.ndarray:
    """Hashes of all windows of ``long`` words from those of ``short`` (at least half as long)."""
    n = len(h) - (long - short)
    return join_hash(h[:n], h[long - short:], lane) if n > 0 else h[:0]


def window_hash(codes: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hashes of all windows of ``length`` words; ``codes`` are the hashes of the words."""
    steps = halves(length)
    h = mix(codes ^ np.uint64(lane))
    for short, long in zip(steps, steps[1:], strict=False):
        h = extend_hash(h, short, long, lane)
    return h


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sequence_offsets(counts: DataFrame, keys: list[str], order: str, size: str, out: str) -> DataFrame:
    """Running sums before each row of a table of bins (``keys`` may be empty: one bounded table)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(size).over(w), F.lit(0).cast("long")))
