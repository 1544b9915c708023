"""Keys matched to the nearest known spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a q-gram.
Q = 2


def _grams(key: Column) -> Column:
    """The q-grams of a key, the second and later ones of a kind numbered, so that they count."""
    cut = F.transform(F.sequence(F.lit(1), F.char_length(key) - (Q - 1)), lambda i: F.substr(key, i, F.lit(Q)))
    return F.transform(cut, lambda g, i: F.concat_ws(":", g, F.size(F.filter(F.slice(cut, F.lit(1), i), lambda h: h == g)).cast("string")))


def _deletions(key: Column, times: int) -> Column:
    """A key and all that is left of it when up to ``times`` letters go."""
    level = out = F.array(key)
    for _ in range(times):
        shorter = F.transform(level, lambda s: F.when(F.char_length(s) > 0, F.transform(
            F.sequence(F.lit(1), F.char_length(s)), lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)))).otherwise(F.array().cast("array<string>")))
        level = F.array_distinct(F.flatten(shorter))
        out = F.array_union(out, level)
    return out


def near_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str, distance: int = 2) -> DataFrame:
    """``(key, match, distance)``: each different key of ``left`` with the nearest of ``right``, where one lies within ``distance`` edits.

    Of several at the same distance the smallest counts. Null keys match nothing. No pair within the distance is
    missed. Two keys that near share a q-gram among their ``q * distance + 1`` rarest ones, so these are joined by equality,
    together with the length (a key asks for the lengths that can be near), which cuts the groups of frequent
    q-grams; none is dropped, and adaptive execution splits what is still large. Keys too short for that share what is left of them when
    up to ``distance`` letters go. Pairs found are compared by ``levenshtein``.
    """
    prefix = Q * distance + 1
    short = prefix + Q - 2  # keys up to this length have too few q-grams
    key, n = F.col("key"), F.char_length("key")
    sides = [df.where(F.col(f"`{c}`").isNotNull()).select(F.col(f"`{c}`").cast("string").alias("key")).distinct() for df, c in ((left, left_key), (right, right_key))]
    known = [side.where(n > short).select("key", n.alias("len"), F.explode(_grams(key)).alias("gram")) for side in sides]
    counts = known[0].select("gram").unionByName(known[1].select("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    rare = []
    for side in known:
        ranked = side.join(counts, "gram").groupBy("key", "len").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("all"))
        rare.append(ranked.select("key", "len", F.explode(F.slice("all", 1, prefix)["gram"]).alias("gram")))
    asked = rare[0].withColumn("len", F.explode(F.sequence(F.col("len") - distance, F.col("len") + distance)))
    by_grams = asked.withColumnRenamed("key", "a").join(rare[1].withColumnRenamed("key", "b"), ["gram", "len"]).select("a", "b")

    # One of the two is short; the other is longer by the distance at most.
    small = [side.where(n <= short + distance).select("key", F.explode(_deletions(key, distance)).alias("rest")) for side in sides]
    by_rest = small[0].withColumnRenamed("key", "a").join(small[1].withColumnRenamed("key", "b"), "rest").select("a", "b")

    pairs = by_grams.unionByName(by_rest).distinct().withColumn("distance", F.levenshtein("a", "b", distance)).where("distance >= 0")
    best = pairs.groupBy(F.col("a").alias("key")).agg(F.min(F.struct("distance", "b")).alias("m"))
    return best.select("key", F.col("m.b").alias("match"), F.col("m.distance").alias("distance"))
