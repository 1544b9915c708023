"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the smallest node near it."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; edges run from large to small."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _sum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``: the smallest node that can be reached.

    Links run between comparable ids of one type; loops and nulls are left out. Only counts reach the driver. The
    number of rounds grows with the logarithm of the longest chain. Every round is written, so that a lost executor
    costs one read. A node with very many links is a key of joins only, which adaptive execution splits, and of
    sums that combine in the map tasks.
    """
    now = scratch.save(edges.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _sum(now)
    while before[0]:
        grown = scratch.save(_large(now).distinct())
        after = scratch.save(_small(grown).where("a <> b").distinct())
        scratch.drop(now, grown)
        now, seen = after, _sum(after)
        if seen == before:
            break
        before = seen
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
