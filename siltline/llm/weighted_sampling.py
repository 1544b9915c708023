"""Document fingerprints by consistent weighted sampling, compared across neighbouring documents."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import _MIX_1, _MIX_2, Scratch, mix, partitions

#: Samples of a fingerprint, 16 bits each, and the seed. A worker remembers 2 ** KEPT_BITS terms of weight one and 2 ** HEAVY_BITS others.
SAMPLES, KEPT_BITS, HEAVY_BITS, SEED = 64, 18, 15, 2010
_ROWS = 512  # terms at a time, whose numbers stay in a core's cache
_LOW = 0 if sys.byteorder == "little" else 1  # the half of 64 bits that has the low ones


def _scrambled(x: np.ndarray, held: np.ndarray) -> np.ndarray:
    """``mix``, in the place of its argument."""
    for shift, factor in ((30, _MIX_1), (27, _MIX_2)):
        np.bitwise_xor(x, np.right_shift(x, np.uint64(shift), out=held), out=x)
        np.multiply(x, factor, out=x)
    return np.bitwise_xor(x, np.right_shift(x, np.uint64(31), out=held), out=x)


def _fraction(v: np.ndarray) -> np.ndarray:
    """24 bits as a number between 0 and 1."""
    f = v.view(np.uint32)[:, _LOW::2].astype(np.float32)
    f += np.float32(0.5)
    f /= np.float32(1 << 24)
    return f


class _Kept:
    """What ``make`` gives for a term, remembered in the slot of its hash; what a slot holds is used for the very same term only."""

    def __init__(self, make, width: int, bits: int):
        self.make, self.shift = make, np.uint64(64 - bits)
        self.tag, self.full, self.held = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, bool), np.empty((1 << bits, width), np.float32)

    def of(self, terms: np.ndarray) -> np.ndarray:
        slot = (terms >> self.shift).astype(np.int64)
        new = np.flatnonzero(~self.full[slot] | (self.tag[slot] != terms))
        out = self.held.take(slot, 0)
        if len(new):
            made = self.make(terms[new])
            out[new] = made
            into, one = np.unique(slot[new], return_index=True)
            self.tag[into], self.full[into], self.held[into] = terms[new[one]], True, made[one]
        return out


class _Gammas:
    """r, ln c and beta of terms in every sample: r and c are Gamma(2, 1), beta is uniform; all from the 64-bit hash of
    the term and the number of the sample. A term of weight one has level zero, so its ln a is one number for each sample."""

    def __init__(self, samples: int, seed: int):
        self.samples = samples
        with np.errstate(over="ignore"):
            self.sample = mix(np.arange(samples, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 40) + np.uint64(1))
        self.ones, self.heavy = _Kept(self._at_one, samples, KEPT_BITS), _Kept(self._side_by_side, 3 * samples, HEAVY_BITS)

    def draw(self, terms: np.ndarray) -> list[np.ndarray]:
        """In place as far as it goes, as these arrays are what takes the time."""
        held = np.empty((len(terms), self.samples), np.uint64)
        x = _scrambled(mix(terms)[:, None] ^ self.sample, held)
        y = _scrambled(x ^ np.uint64(0xC0FFEE), held)
        low, out = np.uint64((1 << 24) - 1), []
        for v in (x, y):
            a = _fraction(np.right_shift(v, np.uint64(40), out=held))
            np.right_shift(v, np.uint64(16), out=held)
            a *= _fraction(np.bitwise_and(held, low, out=held))
            np.negative(np.log(a, out=a), out=a)
            out.append(np.maximum(a, np.float32(1e-7), out=a))
        np.log(out[1], out=out[1])
        np.left_shift(np.bitwise_and(x, np.uint64(0xFFFF), out=held), np.uint64(8), out=held)
        return [*out, _fraction(np.bitwise_or(held, np.bitwise_and(y, np.uint64(0xFF), out=y), out=held))]

    def _at_one(self, terms: np.ndarray) -> np.ndarray:
        r, ln_c, beta = self.draw(terms)
        return ln_c - r * (np.float32(0) - beta + 1)

    def _side_by_side(self, terms: np.ndarray) -> np.ndarray:
        return np.concatenate(self.draw(terms), 1)

    def of(self, terms: np.ndarray) -> list[np.ndarray]:
        return np.split(self.heavy.of(terms), 3, 1)


@lru_cache(maxsize=2)
def _gammas(samples: int, seed: int) -> _Gammas:
    return _Gammas(samples, seed)


class Pairs:
    """The words of a text and the hash of each pair of neighbours in their order; of the word itself if there is one only."""

    def __init__(self, text: str, seed: int = SEED, known: list[tuple[int, np.ndarray]] = ()):
        """``known``: hashes that are known of stretches of this text, by the place of their first pair."""
        self.words, self.seed = text.encode().split(), seed
        if len(self.words) < 2:
            self.hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)
            return
        self.hashes, at = np.empty(len(self.words) - 1, np.uint64), 0
        for place, own in known:
            self.hashes[at:place] = self._hashed(at, place)
            self.hashes[place:place + len(own)] = own
            at = place + len(own)
        self.hashes[at:] = self._hashed(at, len(self.hashes))

    def _hashed(self, first: int, last: int) -> np.ndarray:
        if first >= last:
            return np.zeros(0, np.uint64)
        words = self.words[first:last + 1]
        pairs = map(b" ".join, zip(words, words[1:], strict=False))
        return np.fromiter(map(xxhash.xxh64_intdigest, pairs, repeat(self.seed)), np.uint64, last - first)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.hashes, return_counts=True)


def joined(before: Pairs, head: str, after: Pairs, tail: str) -> Pairs:
    """The pairs of ``head + tail``, the beginning of one text and that of another; those that both cuts leave whole are not hashed again."""
    one, two, space = head.encode(), tail.encode(), b" \t\n\r\x0b\x0c"
    m, n = len(one.split()), len(two.split())
    if min(m, n) < 2:
        return Pairs(head + tail)
    whole = m + n - int(one[-1] not in space and two[0] not in space)  # a word may run across
    first, last = before.hashes[:m - 2], after.hashes[1:max(1, n - 2)]
    # the words of the tail but its first end the whole text, and the pairs among them but the last are as in ``after``
    return Pairs(head + tail, known=[(0, first), (whole - n + 1, last)] if n > 3 else [(0, first)])


def terms(text: str, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different pairs of neighbouring words of a text and their counts."""
    return Pairs(text, seed).counted()


def sample(counted: tuple[np.ndarray, np.ndarray], samples: int = SAMPLES, seed: int = SEED) -> np.ndarray:
    """16 bits for each sample of a weighted set, given as ascending hashes of its terms and their weights. Two sets agree in a sample with
    the probability of their generalised Jaccard similarity (sum of smaller weights by sum of larger), up to 2 ** -16."""
    kinds, counts = counted
    if not len(kinds):
        return np.zeros(samples, np.uint16)
    gammas = _gammas(samples, seed)
    best, term, level = np.full(samples, np.inf, np.float32), np.zeros(samples, np.uint64), np.zeros(samples, np.int64)
    every = np.arange(samples)

    def compare(k: np.ndarray, ln_a: np.ndarray, t: np.ndarray | None) -> None:
        row = ln_a.argmin(0)
        low, own = ln_a[row, every], k[row]
        less = (low < best) | (low == best) & (own < term)  # of equal ones the term that comes first
        best[less], term[less] = low[less], own[less]
        level[less] = 0 if t is None else t[row[less], every[less]]

    light = kinds[counts == 1]
    for at in range(0, len(light), _ROWS):
        k = light[at:at + _ROWS]
        compare(k, gammas.ones.of(k), None)
    heavy, weight = kinds[counts > 1], np.log(counts[counts > 1].astype(np.float64)).astype(np.float32)
    for at in range(0, len(heavy), _ROWS):
        k = heavy[at:at + _ROWS]
        r, ln_c, beta = gammas.of(k)
        t = np.floor(weight[at:at + _ROWS, None] / r + beta)
        compare(k, ln_c - r * (t - beta + 1), t)
    return (mix(term ^ mix(level.astype(np.uint64))) >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, guest, doc_id, text) in order: each own row with the next row of its part."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    waiting = None  # part, doc_id, text, pairs, fingerprint
    for batch in batches:
        out = []
        for part, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if guest and (waiting is None or waiting[0] != part):
                continue  # a second guest of the part
            pairs = Pairs(text)
            own = sample(pairs.counted())
            if waiting is not None:
                assert waiting[0] == part, "a part without a next document"
                _, last_id, last, last_pairs, last_print = waiting
                n = len(last) // 3
                edited = last[:len(last) - n] + text[:n]
                changed = last_print if edited == last else sample(joined(last_pairs, last[:len(last) - n], pairs, text[:n]).counted())
                out.append((last_id, len(last), hashlib.sha256(edited.encode()).hexdigest(), last_print.tobytes().hex(),
                            changed.tobytes().hex(), likeness(last_print, changed), likeness(last_print, own)))
            waiting = None if guest else (part, doc_id, text, pairs, own)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 7, types, strict=True)], names=names)


def fingerprints(docs: DataFrame, least_rows: int = 500) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is the beginning of the next document.

    One row per row of ``docs(doc_id, text)``: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The next document is the next smaller doc_id (nulls last; equal ids by the descending md5
    of the text; after the last document comes the first; a single document is next to itself). A null text is empty;
    empty texts have the fingerprint zero, and all wordless texts are alike.

    The order is cut into four parts for each shuffle partition, of ``least_rows`` documents at least; a part also gets
    the first document of the part after it. Only these first ids reach the driver, two numbers for each part.
    """
    scratch = Scratch(docs.sparkSession, "sampling")
    keys = scratch.save(docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("mark")))
    n = max(1, min(4 * partitions(docs.sparkSession), keys.count() // least_rows))
    cuts = sorted(set(keys.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []

    def place(ids: pa.Array) -> pa.Array:  # parts in the order of the documents: the largest ids are part 0
        at = len(cuts) - np.searchsorted(np.array(cuts), ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), len(cuts), at).astype(np.int32))

    part = F.arrow_udf(place, "int")(F.col("doc_id").cast("long"))
    first = keys.groupBy(part.alias("part")).agg(F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "mark")).alias("x")).select(
        "part", "x.doc_id", "x.mark").collect()
    order = sorted(first, key=lambda r: r["part"])
    heads = [(r["doc_id"], r["mark"], order[k - 1]["part"]) for k, r in enumerate(order)]
    spark = docs.sparkSession
    guests = spark.createDataFrame(heads, "head_id long, head_mark string, goes int")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.md5(text).alias("mark"), part.alias("own"))
    joined = rows.join(F.broadcast(guests), rows.doc_id.eqNullSafe(guests.head_id) & (rows.mark == guests.head_mark), "left")
    places = F.when(F.col("goes").isNull(), F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("guest")))).otherwise(
        F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("guest")), F.struct(F.col("goes").alias("part"), F.lit(True).alias("guest"))))
    spread = joined.select(F.explode(places).alias("p"), "doc_id", "text", "mark").select("p.part", "p.guest", "doc_id", "mark", "text")
    ordered = spread.repartitionByRange(max(partitions(spark), 1), "part").sortWithinPartitions(
        "part", "guest", F.col("doc_id").desc_nulls_last(), F.col("mark").desc())
    return ordered.select("part", "guest", "doc_id", "text").mapInArrow(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
