"""Language of a text by the out-of-place distance of n-gram rank profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltline.llm.common import prepare, whole_row

#: N-grams of one to three letters or word ends; a profile has the most frequent ones.
ORDERS, PROFILE = 3, 400
#: N-grams of a batch are numbered by a table of up to so many entries, else by sorting; n-grams of a language that a task
#: holds before it adds equal ones up, and before it sends them on.
TABLE, HELD, SENT = 1 << 22, 1 << 20, 1 << 22
#: ``accepted`` takes documents at this score at least.
LEAST_SCORE = 0.2
_WIDE = 21  # bits of a letter


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For many texts at once: the document and the number of the n-gram of each occurrence, the letters of each text, and the
    n-grams by number.

    Texts are lower-cased; every run of other characters is one word end, also at both ends of a text. An n-gram is
    written as one number, 21 bits for each letter (plus one) or word end (one), so different ones are never mixed up.
    """
    low = [t.lower() for t in texts]
    size = np.fromiter(map(len, low), np.int64, len(low))
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low)), size + 1)[:len(points)]
    letter = _letters()[points]
    counts = np.bincount(doc[letter], minlength=len(low))
    keep = letter | np.r_[True, letter[:-1]]  # of a run of others one stays
    codes, doc = np.r_[0, np.where(letter, points, 0)[keep], 0], np.r_[0, doc[keep], len(low) - 1]
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(0x110000, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    x, n, real = number[codes], len(alphabet), codes != 0
    two, three = n + x[:-1] * n + x[1:], n + n * n + (x[:-2] * n + x[1:-1]) * n + x[2:]
    pairs = real[:-1] | real[1:]
    ids = np.concatenate([x[real], two[pairs], three[real[1:-1]]])
    docs = np.concatenate([doc[real], np.where(real[:-1], doc[:-1], doc[1:])[pairs], doc[1:-1][real[1:-1]]])
    if n + n * n + n ** 3 <= TABLE:
        there = np.zeros(n + n * n + n ** 3, bool)
        there[ids] = True
        kinds = np.flatnonzero(there)
        place = np.zeros(len(there), np.int32)
        place[kinds] = np.arange(len(kinds))
        ids = place[ids]
    else:
        kinds, ids = np.unique(ids, return_inverse=True)
    written, wide = alphabet + 1, np.int64(_WIDE)
    own = np.empty(len(kinds), np.int64)
    a, b = np.searchsorted(kinds, [n, n + n * n])
    own[:a] = written[kinds[:a]]
    rest = kinds[a:b] - n
    own[a:b] = written[rest // n] << wide | written[rest % n]
    rest = kinds[b:] - n - n * n
    own[b:] = (written[rest // (n * n)] << wide | written[rest // n % n]) << wide | written[rest % n]
    return docs, ids, counts, own


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    kinds, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return kinds, np.bincount(back, np.concatenate([n for _, n in parts]), len(kinds)).astype(np.int64)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the rows (lang, text) of a task."""
    sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            _, ids, _, kinds = grams([t for x, t in zip(langs, texts, strict=True) if x == lang])
            parts = sums.setdefault(lang, [])
            parts.append((kinds, np.bincount(ids, minlength=len(kinds))))
            if sum(len(k) for k, _ in parts) > HELD + 2 * len(parts[0][0]):
                parts[:] = [_added(parts)]
        if sum(len(k) for parts in sums.values() for k, _ in parts) > SENT:  # bounded memory with many languages
            yield from _flush(sums)
    yield from _flush(sums)


def _flush(sums: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    while sums:
        lang, parts = sums.popitem()
        kinds, n = _added(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(kinds), pa.string()), pa.array(kinds), pa.array(n)], names=["lang", "gram", "n"])


def profiles(docs: DataFrame) -> dict[str, list[int]]:
    """The most frequent n-grams of every language of ``docs(lang, text)``, best first; at most ``PROFILE`` for each
    language reach the driver. Counts cover all rows whose lang and text are not null."""
    prepare(docs.sparkSession)
    counts = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(_train, "lang string, gram long, n long")
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= PROFILE)
    out: dict[str, list[int]] = {}
    for r in sorted(rows.select("lang", "place", "gram").collect()):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Learned:
    """Profiles as a table: the rank of each n-gram in each language, ``PROFILE`` where it has none."""

    def __init__(self, learned: dict[str, list[int]]):
        self.names = sorted(learned)
        self.kinds = np.unique(np.array([g for own in learned.values() for g in own], np.int64))
        self.ranks = np.full((len(self.kinds) + 1, max(1, len(self.names))), PROFILE, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.kinds, learned[name]), k] = np.arange(len(learned[name]))

    def of(self, kinds: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.kinds, kinds)
        known = self.kinds[np.minimum(at, len(self.kinds) - 1)] == kinds if len(self.kinds) else np.zeros(len(kinds), bool)
        return self.ranks[np.where(known, at, len(self.kinds))]


def predict(learned: dict[str, list[int]], texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text. A text's profile has its ``PROFILE`` most frequent n-grams, ties to the smaller number,
    as those of the languages. The distance is the mean, over the n-grams of the text's profile, of how far
    their rank is from the one in the language, ``PROFILE`` where the language has none; the score is one less the
    smallest distance as a part of ``PROFILE``. N-grams of equal count share the best rank of their group."""
    return _predict(Learned(learned), texts)


def _predict(learned: Learned, texts: list[str | None]) -> tuple[list[str], list[float]]:
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not texts or not learned.names:
        return langs, scores
    docs, ids, letters, kinds = grams([t or "" for t in texts])
    ranks, by_number = learned.of(kinds), np.argsort(np.argsort(kinds))
    order = np.argsort(docs, kind="stable")
    ids, edge = ids[order], np.searchsorted(docs[order], np.arange(len(texts) + 1))
    for i in np.flatnonzero(letters):
        n = np.bincount(ids[edge[i]:edge[i + 1]], minlength=len(kinds))
        own = np.flatnonzero(n)
        n = n[own]
        if len(own) > PROFILE:
            best = np.lexsort((by_number[own], -n))[:PROFILE]
            own, n = own[best], n[best]
        values = np.sort(n)
        rank = len(n) - np.searchsorted(values, n, "right")
        far = np.abs(ranks[own] - rank[:, None]).sum(0)
        least = int(far.argmin())
        langs[i], scores[i] = learned.names[least], float(1 - far[least] / (len(own) * PROFILE))
    return langs, scores


def classify(docs: DataFrame, learned: dict[str, list[int]]) -> DataFrame:
    """``docs`` with ``found``, a struct of ``lang_pred`` and ``score``; ``und`` and 0 if a text is null, has no letter,
    or nothing was learned. The profiles are bounded (``PROFILE`` for each language) and go with the tasks."""
    tables: list[Learned] = []

    def run(texts: pa.Array) -> pa.Array:
        if not tables:
            tables.append(Learned(learned))
        langs, scores = _predict(tables[0], texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    prepare(docs.sparkSession)
    return docs.withColumn("found", F.arrow_udf(run, "struct<lang_pred:string,score:double>")("text"))


def held_out():
    """Documents that nothing is learned from: crc32 of the doc_id as text, modulo 4, is 2 (a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """One row ``(doc_id, held_out, lang_pred, score)`` per row of ``docs(doc_id, text, lang)``.

    Learns from the documents that are not held out. Repeated rows count as often as they come; an empty table gives
    no rows; other columns are not read.
    """
    learned = profiles(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return classify(rows, learned).select("doc_id", "held_out", "found.lang_pred", "found.score")


def accepted(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without the documents in no language: null or letterless texts and texts whose n-grams are far from
    every profile. All columns of ``docs``, and no others."""
    learned = profiles(docs.where(~held_out()))
    rows = docs.select(whole_row(docs), "text")
    return classify(rows, learned).where((F.col("found.lang_pred") != "und") & (F.col("found.score") >= least)).select("row.*")
