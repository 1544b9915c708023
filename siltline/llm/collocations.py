"""Phrase collocations: frequent runs of words by Rabin-Karp fingerprints, scored against their parts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltline.llm.chunks import GROUP, Marks, with_replies
from siltline.llm.common import Scratch, mix, partitions

#: Words of a phrase at most, occurrences at least, rows of a language, and the per cent of a phrase's occurrences that lie
#: in a longer one where the longer one stands for it.
LONGEST, LEAST, KEPT, COVER = 4, 30, 2000, 80
SCALE = 2_000_000
#: Characters of one language in a chunk, about; a longer text is cut where a piece ends.
CHARS = 3_000_000
#: Lengths whose fingerprints are counted together.
ROUNDS = ((1, 2), (3, 4))
_BASE = 0x9E3779B97F4A7C15
_BREAK = re.compile("[.,;:!?\x0a-\x0d]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD, _GAP, _END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _powers[k] = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])
    return _powers


def prefix(values: np.ndarray) -> np.ndarray:
    """The prefix polynomials of a sequence: entry i is the sum of its first i values, each times a power of the base."""
    return np.r_[np.uint64(0), np.cumsum(values * _power(len(values))[0][:len(values)], dtype=np.uint64)]


def spans(polynomials: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Fingerprints of the runs from ``start`` to ``stop``; equal runs have equal ones, wherever they are."""
    return (polynomials[stop] - polynomials[start]) * _power(len(polynomials))[1][start]


def _same_words(raw: np.ndarray, start: np.ndarray, stop: np.ndarray, lead: np.ndarray) -> bool:
    """Whether each word has the bytes of its leader."""
    size = stop - start
    if (size != size[lead]).any():
        return False
    for at in range(0, len(start), 1 << 17):
        n = size[at:at + (1 << 17)]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own, other = (np.repeat(x, n) + step for x in (start[at:at + (1 << 17)], start[lead[at:at + (1 << 17)]]))
        if (raw[own] != raw[other]).any():
            return False
    return True


def split_words(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words of a text in UTF-8 (A-Z lower-cased), the number of each word in them, and which words begin a
    piece. Words of one fingerprint are compared with the text."""
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    kind = _KIND[raw]
    edge = np.diff(np.r_[False, kind == _WORD, False].astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return [], np.zeros(0, np.int64), np.zeros(0, bool)
    ends = np.cumsum(kind == _END, dtype=np.int64)[start]
    _, first, number = np.unique(spans(prefix(raw.astype(np.uint64) + np.uint64(1)), start, stop), return_index=True, return_inverse=True)
    text = raw.tobytes()
    if _same_words(raw, start, stop, first[number]):
        words = [text[a:b] for a, b in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
    else:
        numbers: dict[bytes, int] = {}
        number = np.array([numbers.setdefault(text[a:b], len(numbers)) for a, b in zip(start.tolist(), stop.tolist(), strict=True)])
        words = list(numbers)
    return words, number, np.r_[True, ends[1:] != ends[:-1]]


def _parts(text: str) -> Iterator[str]:
    """A text, cut into parts of about CHARS characters where pieces end."""
    at = 0
    while len(text) - at > CHARS and (cut := _BREAK.search(text, at + CHARS)):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(chunk, lang, words, numbers, n_words)``: the texts of one language with words as numbers in a list of their own;
    a number that begins a piece is inverted. Written once, read by every round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, {}, {}

        def emit(lang: str) -> pa.RecordBatch:
            nonlocal chunk
            words, number, begins = split_words(b"\n".join(held.pop(lang)))
            del size[lang]
            chunk += 1
            return pa.RecordBatch.from_arrays([
                pa.array([chunk]), pa.array([lang]), pa.array([b" ".join(words)], pa.binary()),
                pa.array([np.where(begins, ~number, number).astype("<i4").tobytes()], pa.binary()), pa.array([len(number)])],
                names=["chunk", "lang", "words", "numbers", "n_words"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in _parts(text or ""):
                    held.setdefault(lang, []).append(part.encode())
                    size[lang] = size.get(lang, 0) + len(part) + 1
                    while sum(size.values()) >= CHARS:
                        yield emit(max(size, key=size.get))
        for lang in list(held):
            yield emit(lang)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return scratch.save(rows.mapInArrow(run, "chunk long, lang string, words binary, numbers binary, n_words long"))


class Grams:
    """The runs of words of a chunk and their fingerprints."""

    def __init__(self, lang: str, words: bytes, numbers: bytes):
        own = np.frombuffer(numbers, "<i4")
        self.words, self.number = words.split(b" ") if len(own) else [], np.where(own < 0, ~own, own)
        seed = xxhash.xxh64_intdigest(lang.encode())
        codes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))
        self.polynomials = prefix(codes[self.number])
        begin = np.r_[np.flatnonzero(own < 0), len(own)]
        self.left = np.repeat(begin[1:], np.diff(begin)) - np.arange(len(own))  # words to the end of the piece

    def hashes(self, starts: np.ndarray, n: int) -> np.ndarray:
        return mix(spans(self.polynomials, starts, starts + n) + np.uint64(n))

    def starts(self, n: int, shorter: np.ndarray | None = None, size: int = 0) -> np.ndarray:
        """Starts of the runs of ``n`` words; with ``shorter``, of those whose runs of ``size`` words all start in it."""
        if shorter is None:
            return np.flatnonzero(self.left >= n)
        good = np.zeros(len(self.left) + n, bool)
        good[shorter] = True
        fits = self.left >= n
        for k in range(n - size + 1):
            fits = fits & good[k:k + len(fits)]
        return np.flatnonzero(fits)

    def rounds(self, known: list, groups: int) -> Iterator[tuple[Marks, list[tuple[int, np.ndarray]]]]:
        """The marks and the starts by length of each round that can be looked at: one more than are known."""
        shorter, size = None, 0
        for k, lengths in enumerate(ROUNDS[:len(known) + 1]):
            at = [(n, self.starts(n, shorter, size)) for n in lengths]
            marks = Marks(np.concatenate([self.hashes(s, n) for n, s in at]), np.zeros(0, np.uint64), groups)
            yield marks, at
            if k < len(known):
                size, shorter = self.frequent(marks, at, known[k])[-1]

    @staticmethod
    def frequent(marks: Marks, at: list[tuple[int, np.ndarray]], replies: list[dict] | None) -> list[tuple[int, np.ndarray]]:
        flags = np.split(marks.answer(replies), np.cumsum([len(s) for _, s in at])[:-1])
        return [(n, s[f]) for (n, s), f in zip(at, flags, strict=True)]

    def phrases(self, starts: np.ndarray, n: int) -> Iterator[tuple[bytes, int]]:
        """Text and occurrences of the runs of ``n`` words that start there. Runs of one fingerprint are compared word by word."""
        runs = np.stack([self.number[starts + k] for k in range(n)], 1)
        _, first, back, count = np.unique(self.hashes(starts, n), return_index=True, return_inverse=True, return_counts=True)
        if (runs[first[back]] != runs).any():
            _, first, count = np.unique(runs, axis=0, return_index=True, return_counts=True)
        for run, c in zip(runs[first].tolist(), count.tolist(), strict=True):
            yield b" ".join([self.words[w] for w in run]), c


def _enough(width: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """Which hashes of one group have ``least`` occurrences in all chunks together."""
    def run(rows: pa.Table) -> pa.Table:
        sizes = [len(x) for x in rows["counts"].to_pylist()]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, :width] = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(-1, width)
        value, counts = wide.view(np.uint64).ravel(), np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint8)
        order = np.argsort(value)
        value = value[order]
        begin = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        good = np.add.reduceat(counts[order].astype(np.int64), begin) >= least
        marked = np.zeros(len(order), bool)
        marked[order] = np.repeat(good, np.diff(np.r_[begin, len(order)]))
        own = [(c, p, np.packbits(x).tobytes()) for c, p, x in zip(
            rows["chunk"].to_pylist(), rows["part"].to_pylist(), np.split(marked, np.cumsum(sizes)[:-1]), strict=True) if x.any()]
        kinds = {"chunk": pa.int64(), "part": pa.int64(), "bits": pa.binary()}
        return pa.table({k: pa.array([x[i] for x in own], t) for i, (k, t) in enumerate(kinds.items())})

    return run


def _known(chunks: DataFrame, replies: DataFrame | None) -> DataFrame:
    return with_replies(chunks.select("chunk", "lang", "words", "numbers"), replies)


def frequent_phrases(chunks: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """``(lang, size, phrase, f)`` of all runs of up to LONGEST words that occur ``least`` times in a language.

    Round by round each chunk sends the fingerprints of its runs, packed by group with a count of one byte (255 stands for
    more), to the counts of all chunks; a bit for each comes back. A run is sent only if the shorter ones in it may be
    frequent. Fingerprints are cut to the bytes that leave few false hits: those cost work only, as the runs that are
    left are compared with their text in the chunk, and counted by their text in the end.
    """
    total = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    groups = max(4 * partitions(chunks.sparkSession), -(-2 * total // GROUP))
    width = min(8, max(3, -(-(max(total, 2).bit_length() + 10 - groups.bit_length()) // 8)))
    replies = None
    for k in range(len(ROUNDS)):
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, lang, words, numbers, *known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    *_, (marks, _) = Grams(lang, words, numbers).rounds(known, groups)
                    if not len(marks.kinds):
                        continue
                    rows, n = marks.ask(chunk, width), np.minimum(marks.n, 255).astype(np.uint8)
                    counts = [n[a:b].tobytes() for a, b in zip(marks.start, marks.stop, strict=True)]
                    yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(counts, pa.binary())], names=["part", "chunk", "low", "counts"])

        asked = _known(chunks, replies).mapInArrow(ask, "part long, chunk long, low binary, counts binary")
        found = asked.groupBy("part").applyInArrow(_enough(width, least), "chunk long, part long, bits binary")
        found = scratch.save(found.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias(f"round_{k}")))
        replies = found if replies is None else replies.join(found, "chunk", "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lang, words, numbers, *known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = Grams(lang, words, numbers)
                for (marks, at), answer in zip(grams.rounds(known[:-1], groups), known, strict=True):
                    for n, starts in grams.frequent(marks, at, answer):
                        found = list(grams.phrases(starts, n))
                        for i in range(0, len(found), 1 << 15):
                            phrase, count = zip(*found[i:i + (1 << 15)], strict=True)
                            yield pa.RecordBatch.from_arrays([
                                pa.array([lang] * len(phrase)), pa.array([n] * len(phrase), pa.int32()),
                                pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(count, pa.int64())], names=["lang", "size", "phrase", "f"])

    counted = _known(chunks, replies).mapInArrow(texts, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _joined(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def collocations(docs: DataFrame, least: int = LEAST, kept: int = KEPT, cover: int = COVER) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``kept`` phrases of each language of ``docs(text, lang)``.

    Texts (A-Z lower-cased; null: empty) fall into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+``;
    a phrase is a run of 2 to LONGEST words of a piece with ``a >= least`` occurrences in its language (null: ``und``). Its
    score is that of the cut where ``floor(2000000 a / (l + r))`` is least, ties to the shortest first part; ``l`` and
    ``r`` are the occurrences of the two parts, ``n`` the words of the language. A phrase goes if its words lie in a longer
    one that has ``cover`` per cent of its occurrences. Order: score and ``a`` descending, then the phrase by bytes.
    Repeated rows count as often as they are there, a doc_id isn't read, languages without a phrase and empty tables
    give no rows. Counting is exact; no row or phrase is dropped before the end. A phrase of a third of all documents
    adds one entry for each chunk to its group. A piece without an end is one stretch, so it takes memory of its length.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    chunks = numbered(docs, scratch)
    freq = scratch.save(frequent_phrases(chunks, least, scratch))
    whole = freq.select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    size, k = F.col("size"), F.col("k")
    cuts = whole.where("size >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.lit(1), k).alias("head"), _joined(k + 1, size - k).alias("tail"))
    scored = cuts.join(freq.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"]) \
        .join(freq.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]) \
        .withColumn("score", F.expr(f"cast({SCALE} as decimal(7, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda s: F.transform(F.sequence(F.lit(1), size - s + 1), lambda i: _joined(i, s))))
    longer = whole.where("size >= 3").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = best.join(longer, ["lang", "phrase"], "left").where(
        f"longer is null or cast(100 as decimal(3, 0)) * cast(longer as decimal(19, 0)) < cast({cover} as decimal(3, 0)) * cast(a as decimal(19, 0))")

    rows = free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= kept)
    words = chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return rows.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
