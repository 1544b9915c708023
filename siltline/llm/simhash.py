"""Near duplicates by SimHash fingerprints, found by hashing the balls around them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import Scratch, rest_of, whole_row, words_of
from siltline.llm.components import components

RADIUS, SHINGLE = 3, 3
#: The odd bit of the radius is given away by leaving out one of three blocks of bits.
BLOCKS = ((0, 21), (21, 21), (42, 22))
#: Buckets up to this many fingerprints are compared as a small matrix, larger ones by lookups.
SMALL = 256
#: Rows that a task looks at together, about, and links that it holds before it thins them out.
ROWS, HELD = 1 << 16, 1 << 20
_ALL = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the lower-cased (A-Z only) word shingles; 0 if there is no word."""
    words = words_of(text)
    if not words:
        return 0
    words = [w.lower() for w in words]
    runs = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in runs), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_column(shingle: int):
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
        return pa.array(out.view(np.int64))

    return run


def _masks() -> list[tuple[int, int, int]]:
    """(block, bits kept, bits flipped) of every variant, as signed numbers."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    out = []
    for block, (shift, width) in enumerate(BLOCKS):
        keep = _ALL ^ (((1 << width) - 1) << shift)
        out += [(block, signed(keep), signed(f)) for f in (0, *(1 << i for i in range(64) if keep >> i & 1))]
    return out


def _variants(prints: DataFrame, *more: str) -> DataFrame:
    """Every fingerprint with all variants within half the radius, one block of bits left out at a time."""
    masks = F.array(*(F.struct(F.lit(b).alias("block"), F.lit(k).alias("keep"), F.lit(f).alias("flip")) for b, k, f in _masks()))
    return prints.select("fp", *more, F.explode(masks).alias("m")).select(
        F.col("m.block").alias("block"), F.col("fp").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("key"), "fp", *more)


def _close(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within a small bucket: each fingerprint and the first one of its component."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= RADIUS
    label = np.arange(len(prints))
    while True:
        new = np.where(near, label[None, :], len(prints)).min(1)
        if (new == label).all():
            return prints, prints[label]
        label = new


def _lookup(prints: np.ndarray, block: int, key: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Links within a large bucket, a bounded number of lookups for each fingerprint.

    Members differ from the key in one kept bit at most. With equal left-out bits, or one different, any two are
    linked (2 + 1); a member equal to the key on the kept bits is linked with any at two left-out bits (1 + 2) and
    with its like at three. Every pair within the radius has a bucket in which one of these holds.
    """
    shift, width = BLOCKS[block]
    part = (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    keep = np.uint64(_ALL ^ (((1 << width) - 1) << shift))
    values, first, back = np.unique(part, return_index=True, return_inverse=True)
    heads = prints[first]
    a, b = [prints], [heads[back]]

    def tie(x: np.ndarray, who: np.ndarray, among: np.ndarray, whose: np.ndarray, bits: tuple) -> None:
        want = x ^ np.uint64(sum(1 << i for i in bits))
        at = np.minimum(np.searchsorted(among, want), len(among) - 1)
        hit = among[at] == want
        a.append(who[hit])
        b.append(whose[at[hit]])

    core = np.unique(prints[(prints & keep) == key])
    inner = (core >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    order = np.argsort(inner)
    core, inner = core[order], inner[order]
    for i in range(width):
        tie(values, heads, values, heads, (i,))
    if len(core):
        for bits in combinations(range(width), 2):
            tie(inner, core, values, heads, bits)
        for bits in combinations(range(width), 3):
            tie(inner, core, inner, core, bits)
    return np.concatenate(a), np.concatenate(b)


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of ordered rows (block, key, ...), cut between buckets: the last one of a batch waits for the next."""
    held: list[list[np.ndarray]] = []
    waiting = 0
    for batch in batches:
        rows = [batch.column(0).to_numpy(), *(batch.column(i).to_numpy().view(np.uint64) for i in range(1, batch.num_columns))]
        if not len(rows[0]):
            continue
        held.append(rows)
        waiting += len(rows[0])
        if waiting < ROWS or held[0][0][-1] == rows[0][-1] and held[0][1][-1] == rows[1][-1]:
            continue  # few rows, or one bucket so far
        waiting = 0
        rows = [np.concatenate(x) for x in zip(*held, strict=True)]
        cut = int(np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))[-1]) + 1
        held = [[x[cut:] for x in rows]]
        yield [x[:cut] for x in rows]
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _sizes(block: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (key[1:] != key[:-1])])
    return edge, np.diff(np.r_[edge, len(key)])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links and the smallest one of its component, loops left out: a tree in the place of many links."""
    nodes, back = np.unique(np.r_[a, b], return_inverse=True)
    i, j, label = back[:len(a)], back[len(a):], np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _thinned(links: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """What a task has found, as trees: at most one link for each node, however many buckets its pairs met in."""
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for x, y in links:
        a.append(x)
        b.append(y)
        if sum(map(len, a)) > HELD + 2 * len(a[0]):
            a, b = ([x] for x in _forest(np.concatenate(a), np.concatenate(b)))
    pair = _forest(np.concatenate(a), np.concatenate(b))
    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in pair], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _thinned(_verified(batches))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of fingerprints within the radius, from buckets that arrive in order."""
    for block, key, fp in _whole_buckets(batches):
        edge, size = _sizes(block, key)
        two = edge[size == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= RADIUS]
        a, b = [fp[two]], [fp[two + 1]]
        for at, n in zip(edge[size > 2], size[size > 2], strict=True):
            x, y = _close(fp[at:at + n]) if n <= SMALL else _lookup(fp[at:at + n], int(block[at]), key[at])
            a.append(x)
            b.append(y)
        yield np.concatenate(a), np.concatenate(b)


def fingerprint_links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of different fingerprints within the radius."""
    rows = _variants(prints).repartition("block", "key").sortWithinPartitions("block", "key")
    return scratch.save(rows.mapInArrow(_verify, "a long, b long"))


def _labelled(docs: DataFrame, shingle: int, scratch: Scratch, *more: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as (doc_id, fp, more), and (print, label, least) of each fingerprint: the smallest one of its
    component, and the smallest doc_id of its own."""
    rows = scratch.save(docs.select("doc_id", _fingerprint_column(shingle)("text").alias("fp"), *more))
    prints = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(fingerprint_links(prints, scratch), scratch)
    return rows, scratch.save(prints.join(found, prints.fp == found.node, "left").select(
        F.col("fp").alias("print"), F.coalesce("label", "fp").alias("label"), "least"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row ``(doc_id, fingerprint, component_id, component)`` per row of ``docs(doc_id, text)``; others are not read.

    Fingerprints that differ in at most three bits are linked; a component is named by its smallest doc_id. A null or
    wordless text has fingerprint zero, which is linked like any other. A null doc_id stays a row and names no
    component unless all ids of the component are null (``component``, the smallest fingerprint, still tells them apart). Repeated rows stay repeated; an empty table gives no rows.

    Each different fingerprint, however many texts share it, sends out one row per variant: with one of three blocks
    of bits left out, itself and all with one further bit flipped. Of three differing bits one lies in a block that is
    left out, and the other two are met half way, so no pair is lost; what meets is verified bit by bit.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows, labelled = _labelled(docs, shingle, scratch)
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    names = scratch.save(labelled.join(named, "label").select("print", "component_id", "label"))
    return rows.join(names, rows.fp == names["print"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.lower(F.lpad(F.hex("label"), 16, "0")).alias("component"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component of ``near_duplicates``: its smallest doc_id, nulls last; of equal ids the smallest by a
    hash of the text, then by the other columns as JSON.

    All columns of ``docs`` are returned, and no others; a document that is repeated as a whole stays once. Texts without a word
    have fingerprint zero and are one group with all that is linked to it.
    """
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    mark, rest = F.xxhash64(F.coalesce("text", F.lit(""))), rest_of(docs, "doc_id", "text")
    rows, labelled = _labelled(docs, shingle, scratch, mark.alias("mark"), F.xxhash64(rest).alias("rest"))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "mark", "rest")).alias("row")
    kept = scratch.save(rows.join(labelled, rows.fp == labelled["print"]).groupBy("label").agg(one).select("row.*"))
    own = docs.select(whole_row(docs), F.col("doc_id").alias("id"), mark.alias("own_mark"), F.xxhash64(rest).alias("own_rest"), rest.alias("order"))
    there = own.id.eqNullSafe(kept.doc_id) & (own.own_mark == kept.mark) & (own.own_rest == kept.rest)
    return own.join(kept, there, "left_semi").groupBy("id", "own_mark", "own_rest").agg(F.min_by("row", "order").alias("row")).select("row.*")
