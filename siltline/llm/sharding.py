"""Shards that all hold the sources in the same proportion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import Scratch
from siltline.llm.ranking import bins, group_name, running, seeded_key, share

SEED = "shards-1"


def interleave(docs: DataFrame, shards: int = 24, seed: str = SEED) -> DataFrame:
    """One row ``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row of ``docs(doc_id, text, source)``.

    Rows of a source are put in a seeded order; the row at place r of n gets the fraction (r + u) / n, with a seeded
    u of the source. All rows in the order of their fractions are cut into shards whose counts differ by one at most
    (law ``rows``), so every shard holds the sources as the whole does; ``slot`` is the place inside the shard. Places
    come from bins of bounded size, so neither a large source nor many sources of one row meet in one task.

    A null text has size 8 and checksum 0, a null source is a source of its own, a null doc_id is as good as any.
    Equal rows are told apart by nothing, and their places may be swapped. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    key = seeded_key(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    rows = scratch.save(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"),
        group_name("source").alias("group"), key.alias("key"), F.lit(1).alias("one")))
    sizes = rows.groupBy("group").agg(F.count("*").alias("n"), F.min(share(seeded_key(seed, F.col("group")))).alias("shift"))
    total = rows.count()
    n_bins = bins(total)
    binned = rows.withColumn("bin", F.floor(share(F.col("key")) * n_bins))
    ranked = running(binned, ["group"], "bin", ["key"], "one", "place").join(sizes, "group")
    part = (F.col("place") + F.col("shift")) / F.col("n")
    ranked = scratch.save(ranked.select("doc_id", "size", "text_crc32", "group", "key", "one", part.alias("part"),
                                        F.floor(part * n_bins).alias("bin")))
    return running(ranked, [], "bin", ["part", "group", "key"], "one", "place").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.expr(f"place * {shards} div {max(total, 1)}").cast("int").alias("shard"), "place",
    ).select("doc_id", "size", "text_crc32", "law", "shard",
             (F.col("place") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")).cast("long").alias("slot"),
             F.lit(None).cast("int").alias("grown_shard"))
