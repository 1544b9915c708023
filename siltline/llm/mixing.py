"""Sources mixed to target weights in whole blocks of words."""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import Scratch, rest_of, whole_row
from siltline.llm.ranking import bins, group_name, running, seeded_key, share

WEIGHTS = (5, 2, 1)
#: A source is taken at most so many times.
PASSES = 3
#: A block has at most so many words, and at most this part of the smallest target.
BLOCK, FINENESS = 1024, 400
SEED = "mixture-1"


def targets(sizes: list[int], weights: list[int], most: int = PASSES) -> list[Fraction]:
    """Shares of the sum of sizes by weight; none above ``most`` times its size, the excess shared again."""
    out, left, rest = [Fraction(0)] * len(sizes), sum(sizes), sum(weights)
    order = sorted(range(len(sizes)), key=lambda i: (Fraction(most * sizes[i], weights[i]), i))
    for at, i in enumerate(order):
        if most * sizes[i] * rest > weights[i] * left:
            for j in order[at:]:
                out[j] = Fraction(weights[j] * left, rest)
            break
        out[i] = Fraction(most * sizes[i])
        left, rest = left - most * sizes[i], rest - weights[i]
    return out


def seats(shares: list[Fraction], blocks: int, most: list[int]) -> list[int]:
    """Sainte-Laguë: ``blocks`` seats by the highest quotients share / (2 seats + 1), never above ``most``; ties by place.

    Starts from the rounded quotas and moves single seats, so the work follows the number of sources, not of blocks.
    """
    whole = sum(shares)
    if not whole:
        return [0] * len(shares)
    have = [min(m, (2 * s * blocks / whole + 1) // 2) for s, m in zip(shares, most, strict=True)]
    have = [int(x) for x in have]
    up = [(-s / (2 * h + 1), i) for i, (s, h, m) in enumerate(zip(shares, have, most, strict=True)) if s and h < m]
    heapq.heapify(up)
    short = blocks - sum(have)
    while short > 0 and up:
        _, i = heapq.heappop(up)
        have[i] += 1
        short -= 1
        if have[i] < most[i]:
            heapq.heappush(up, (-shares[i] / (2 * have[i] + 1), i))
    down = [(s / (2 * h - 1), -i) for i, (s, h) in enumerate(zip(shares, have, strict=True)) if h]
    heapq.heapify(down)
    while short < 0 and down:
        _, i = heapq.heappop(down)
        have[-i] -= 1
        short += 1
        if have[-i]:
            heapq.heappush(down, (shares[-i] / (2 * have[-i] - 1), i))
    return have


def plan(sizes: list[tuple[str, int]], weights: tuple[int, ...] = WEIGHTS, shards: int = 1) -> list[dict]:
    """For each source in the order of its name: target, blocks and the seats it has after each shard."""
    sizes = sorted(sizes, key=lambda x: x[0].encode())
    words = [n for _, n in sizes]
    goal = targets(words, [weights[i % len(weights)] for i in range(len(sizes))])
    positive = [t for t in goal if t]
    block = max(1, min(BLOCK, int(min(positive) // FINENESS))) if positive else 1
    total = -(-sum(words) // block)
    own = [-(-n // block) for n in words]
    most = [PASSES * b for b in own]
    upto = [seats(goal, total * (s + 1) // shards, most) for s in range(shards)]
    return [{"group": g, "source_size": n, "target": float(t), "block": block, "blocks": b, "seats": [u[i] for u in upto]}
            for i, ((g, n), t, b) in enumerate(zip(sizes, goal, own, strict=True))]


def _overlap(low: str, high: str):
    """Words of the document between two places in the stream of its source."""
    end = F.col("start") + F.col("size")
    return F.greatest(F.lit(0), F.least(end, F.col(high)) - F.greatest("start", F.col(low)))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = 1, seed: str = SEED, rest: Column | None = None) -> tuple[DataFrame, list[dict]]:
    """Rows ``(doc_id, mark, group, rest, source, size, source_size, target, taken, passes, head, head_to, tail)``, and the plan.

    The words of each source, its documents in a seeded order, are a stream cut into equal blocks (the last may be
    shorter). Sainte-Laguë gives each source a whole number of blocks, and there is one shard. A source takes all its blocks
    ``passes`` times and the rest as a run that starts at a seeded block and goes round: the words ``[head, head_to)``
    of a document and its first ``tail`` words, where the run has gone round. Only the sizes of the sources reach the
    driver. A null text has no words; a null source is the last source; repeated rows are documents like all others.
    ``mark`` is the md5 of the text, ``group`` the source under a name that is never null; ``rest`` is a number by which
    rows of equal id, text and source are told apart and put in order.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.coalesce(F.col("text"), F.lit(""))
    mark = F.md5(text)
    rows = scratch.save(docs.select(
        "doc_id", "source", mark.alias("mark"), group_name("source").alias("group"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("size"), (F.lit(0).cast("long") if rest is None else rest).alias("rest"),
    ).withColumn("key", seeded_key(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("mark"))))
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    quotas = plan([(g["group"], g["size"]) for g in groups], weights, shards)
    spark = docs.sparkSession
    parts = spark.createDataFrame(
        [(q["group"], q["source_size"], q["target"], q["block"], q["blocks"], q["seats"][-1]) for q in quotas],
        "group string, source_size long, target double, block long, blocks long, seats long")
    first = F.floor(share(seeded_key(seed, F.col("group"))) * F.col("blocks"))
    parts = parts.withColumns({
        "passes": F.expr("if(blocks = 0, 0, seats div greatest(blocks, 1))").cast("long"),
        "run": F.expr("if(blocks = 0, 0, seats % greatest(blocks, 1))").cast("long"), "first": first,
    }).withColumns({
        "low": F.col("first") * F.col("block"),
        "high": F.least("source_size", (F.col("first") + F.col("run")) * F.col("block")),
        "round": F.greatest(F.lit(0), F.col("first") + F.col("run") - F.col("blocks")) * F.col("block"),
    }).select("group", "source_size", "target", "passes", "low", "high", "round").withColumn("zero", F.lit(0).cast("long"))
    binned = rows.withColumn("bin", F.floor(share(F.col("key")) * bins(sum(g["n"] for g in groups))))
    placed = running(binned, ["group"], "bin", ["key", "rest"], "size", "start").join(parts, "group")
    head, tail = _overlap("low", "high"), _overlap("zero", "round")
    skipped = F.least(F.col("size"), F.greatest(F.lit(0), F.col("low") - F.col("start")))
    return placed.select(
        "doc_id", "mark", "group", "rest", "source", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + head + tail).cast("long").alias("taken"),
        "passes", skipped.alias("head"), (skipped + head).alias("head_to"), tail.alias("tail")), quotas


def mixture(docs: DataFrame) -> DataFrame:
    """One row ``(doc_id, size, source_size, target, taken)`` per row of ``docs``; see ``mixed``."""
    return mixed(docs)[0].select("doc_id", "size", "source_size", "target", "taken")


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mixture, in the columns of ``docs``: a row for each whole pass, and one for the words of a
    partial pass, in which the words are joined by one space. Documents that the mixture does not take are left out.
    """
    scratch = Scratch(docs.sparkSession, "mixing-take")
    columns, other = docs.columns, rest_of(docs, "doc_id", "text", "source")
    chosen, _ = mixed(docs, weights, rest=F.xxhash64(other))
    identity = ("doc_id", "mark", "group", "rest")
    spans = scratch.save(chosen.where("taken > 0").select(*[F.col(c).alias(f"own_{c}") for c in identity], "passes", "head", "head_to", "tail"))
    rows = docs.select(whole_row(docs), "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("mark"), group_name("source").alias("group"),
                       F.xxhash64(other).alias("rest"), other.alias("order"))
    # of rows that are repeated as a whole one is enough: each of them has spans of its own
    rows = rows.groupBy(*identity).agg(F.min_by("row", "order").alias("row"))
    same = [rows[c].eqNullSafe(spans[f"own_{c}"]) if c == "doc_id" else rows[c] == spans[f"own_{c}"] for c in identity]
    joined = rows.join(spans, same).select("row", F.struct("passes", "head", "head_to", "tail").alias("s"))
    words = F.expr("regexp_extract_all(row.text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)")
    cut = F.array_join(F.concat(F.slice(words, F.col("s.head") + 1, F.col("s.head_to") - F.col("s.head")),
                                F.slice(words, F.lit(1), F.col("s.tail").cast("int"))), " ")
    whole = F.array_repeat(F.col("row.text"), F.col("s.passes").cast("int"))
    texts = F.when((F.col("s.head_to") > F.col("s.head")) | (F.col("s.tail") > 0), F.concat(whole, F.array(cut))).otherwise(whole)
    row = lambda new: F.struct(*(
        new.alias(c) if c.lower() == "text" else F.length(new).cast("long").alias(c) if c.lower() == "n_chars"
        else F.col("row").getField(c).alias(c) for c in columns))
    return joined.select(F.explode(F.transform(texts, row)).alias("new")).select("new.*")
