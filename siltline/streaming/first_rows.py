"""The first row of each key and window of a stream, with a stated survivor and a place for late rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.operators.dedup import first_per_key
from siltline.session import delete, hadoop_path

LATE = "came after its window was closed"
_BATCH, _MARK = "batch_id", "watermark"


class FirstRows:
    """Keeps, for each key and window of ``event_time``, the row that comes first by ``order``.

    A window is closed when the watermark, ``delay`` before the latest time seen in the batches before, has passed its end;
    what it holds is then given out, once. A row of a closed window is late: it is put aside with a reason and changes nothing. Rows without a
    key or time are put aside too. Until it is closed, a window keeps one row for each key, so what is kept is bounded by the keys of one delay.

    Everything that a batch writes lies under its number: a batch that is run again writes the same once more, from what the
    batch before left. Its mark is written last, and rows of a batch without a mark are not given out.
    """

    def __init__(
        self, spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str], event_time: str, order: Sequence[str],
        window: timedelta = timedelta(days=1), delay: timedelta = timedelta(days=1),
    ):
        self.spark, self.target, self.schema, self.keys, self.event_time, self.order = spark, target, schema, list(keys), event_time, list(order)
        self.window, self.delay = (int(d / timedelta(microseconds=1)) for d in (window, delay))
        self.late_schema = T.StructType([*schema.fields, T.StructField("reason", T.StringType())])

    def _micros(self) -> Column:
        return F.unix_micros(F.col(self.event_time).cast("timestamp"))

    def _start(self) -> Column:
        return F.floor(self._micros() / F.lit(self.window)).cast("long") * F.lit(self.window)

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.target}/{kind}/{_BATCH}={batch_id}"

    def _there(self, path: str) -> bool:
        fs, where = hadoop_path(self.spark, path)
        return fs.exists(where)

    def _marks(self) -> dict[int, int]:
        """Watermarks in microseconds by batch: a row for each batch that is done."""
        if not self._there(f"{self.target}/marks"):
            return {}
        return {r[_BATCH]: r[_MARK] for r in self.spark.read.schema(f"{_MARK} long, {_BATCH} long").parquet(f"{self.target}/marks").collect()}

    def _stored(self, kind: str, schema: T.StructType, batches: Sequence[int]) -> DataFrame:
        paths = [p for b in batches if self._there(p := self._path(kind, b))]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def take(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch, with the columns of ``schema``."""
        marks = self._marks()
        before = [b for b in marks if b < batch_id]
        last = max(before, default=-1)
        mark = marks.get(last, -(1 << 62))
        void = F.col(self.event_time).isNull()
        for k in self.keys:
            void = void | F.col(k).isNull()
        rows = rows.select(*self.schema.names)
        late = F.when(void, "no key or time").when(self._start() + self.window <= mark, LATE)
        rows.withColumn("reason", late).where("reason is not null").write.mode("overwrite").parquet(self._path("late", batch_id))
        open_rows = self._stored("open", self.schema, [last])
        fresh = rows.where(late.isNull()).unionByName(open_rows)
        first = first_per_key(fresh.withColumn("_start", self._start()), ["_start", *self.keys], self.order)
        seen = rows.agg(F.max(self._micros())).first()[0]
        mark = max(mark, seen - self.delay) if seen is not None else mark
        first.write.mode("overwrite").parquet(f"{self.target}/merged")
        merged = self.spark.read.schema(first.schema).parquet(f"{self.target}/merged")
        closed = F.col("_start") + self.window <= mark
        merged.where(closed).drop("_start").write.mode("overwrite").parquet(self._path("rows", batch_id))
        merged.where(~closed).drop("_start").write.mode("overwrite").parquet(self._path("open", batch_id))
        self.spark.createDataFrame([(mark,)], f"{_MARK} long").coalesce(1).write.mode("overwrite").parquet(self._path("marks", batch_id))
        delete(self.spark, f"{self.target}/merged")
        for b in before:
            if b != last:  # the last one is kept, as this batch may have to be run again
                delete(self.spark, self._path("open", b))

    def rows(self, with_open: bool = False) -> DataFrame:
        """The rows of closed windows; ``with_open``, also those that open windows have now."""
        done = sorted(self._marks())
        closed = self._stored("rows", self.schema, done)
        return closed.unionByName(self._stored("open", self.schema, done[-1:])) if with_open else closed

    def late(self) -> DataFrame:
        """What was put aside, with the reason."""
        return self._stored("late", self.late_schema, sorted(self._marks()))
