"""Natural-key deduplication of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.streaming.incremental import finish


def first_seen(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """One row per key among rows whose times lie within ``delay``. Which of them stays is not defined.

    The watermark drops keys from the state, so the state is bounded by the keys of one delay. Times
    without a zone are taken as session time, because a watermark needs a zoned timestamp.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def append_available(df: DataFrame, target: str, checkpoint: str, timeout: int | None = None) -> None:
    """Write what is there as Parquet, exactly once per checkpoint, then stop."""
    query = (
        df.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)
