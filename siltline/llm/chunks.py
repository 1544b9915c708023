"""Documents packed in chunks, and the repeated hashes of all chunks counted in packed form."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.llm.common import Scratch, partitions, whole_row, words_of

#: Characters of a chunk, about; a longer text is a chunk of its own.
CHARS = 1_000_000
#: Hashes that meet in one group of a count, at most about.
GROUP = 2_000_000
#: Bytes of a hash that are compared where first occurrences are chosen.
LEAD_WIDTH = 12


def packed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(chunk, rows, n_words)``: all columns of ``docs`` (with ``text``), many documents to a row; written once."""
    columns = docs.columns
    at = [c.lower() for c in columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

        def emit() -> pa.RecordBatch:
            nonlocal chunk, held, size
            rows = pa.concat_arrays(held)
            n = sum(len(words_of(t)) for t in rows.field(at).to_pylist())
            out = pa.RecordBatch.from_arrays([pa.array([chunk]), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), pa.array([n])],
                                             names=["chunk", "rows", "n_words"])
            chunk, held, size = chunk + 1, [], 0
            return out

        for batch in batches:
            rows, start = batch.column(0), 0
            for i, n in enumerate(len(t) if t else 0 for t in rows.field(at).to_pylist()):
                size += n
                if size >= CHARS:
                    held.append(rows.slice(start, i + 1 - start))
                    start = i + 1
                    yield emit()
            if start < len(rows):
                held.append(rows.slice(start))
        if held:
            yield emit()

    whole = docs.select(whole_row(docs))
    kind = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("rows", T.ArrayType(whole.schema["row"].dataType)), T.StructField("n_words", T.LongType())])
    return scratch.save(whole.mapInArrow(run, kind))


class Words:
    """The words of a chunk: by document, and their hashes in one array."""

    def __init__(self, texts: list[str | None]):
        self.words = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.edge = np.r_[0, np.cumsum(sizes)]
        self.codes = np.fromiter((xxhash.xxh64_intdigest(w, 7) for d in self.words for w in d), np.uint64, int(self.edge[-1]))
        self.left = np.repeat(self.edge[1:], sizes) - np.arange(len(self.codes))  # words to the end of the document

    def inside(self, length: int) -> np.ndarray:
        """Starts of the windows that lie in one document."""
        return np.flatnonzero(self.left >= length)


class Marks:
    """Which of the hashes of a chunk are repeated anywhere: asked for in packed form, answered by a bit each."""

    def __init__(self, hashes: np.ndarray, second: np.ndarray, groups: int):
        self.kinds, self.first, self.back, self.n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        self.second = second[self.first] if len(second) else second
        group = ((self.kinds >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
        self.groups, self.start = np.unique(group, return_index=True)
        self.stop = np.r_[self.start, len(self.kinds)][1:]

    def ask(self, chunk: int, width: int) -> pa.RecordBatch:
        """Rows (part, chunk, low bytes of the hashes, bits of those found twice here)."""
        low = self.kinds.view(np.uint8).reshape(-1, 8)[:, :min(width, 8)]
        if width > 8:
            low = np.hstack([low, self.second.view(np.uint8).reshape(-1, 8)[:, :width - 8]])
        spans = list(zip(self.start, self.stop, strict=True))
        return pa.RecordBatch.from_arrays([
            pa.array(self.groups.astype(np.int64)), pa.array([chunk] * len(spans), pa.int64()),
            pa.array([np.ascontiguousarray(low[a:b]).tobytes() for a, b in spans], pa.binary()),
            pa.array([np.packbits(self.n[a:b] > 1).tobytes() for a, b in spans], pa.binary())], names=["part", "chunk", "low", "twice"])

    def _found(self, replies: list[dict] | None, field: str) -> np.ndarray:
        found = np.zeros(len(self.kinds), bool)
        place = {int(g): (a, b) for g, a, b in zip(self.groups, self.start, self.stop, strict=True)}
        for r in replies or ():
            a, b = place[r["part"]]
            found[a:b] = np.unpackbits(np.frombuffer(r[field], np.uint8), count=b - a)
        return found

    def answer(self, replies: list[dict] | None) -> np.ndarray:
        """For each hash that was given, whether it is repeated."""
        return self._found(replies, "bits")[self.back]

    def leads(self, replies: list[dict] | None) -> np.ndarray:
        """For each hash that was given, whether it is the first occurrence of all."""
        out = np.zeros(len(self.back), bool)
        out[self.first[self._found(replies, "lead")]] = True
        return out


def _count(width: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        lows = [np.frombuffer(x, np.uint8).reshape(-1, width) for x in rows["low"].to_pylist()]
        sizes = [len(x) for x in lows]
        wide = np.zeros((sum(sizes), 16), np.uint8)
        wide[:, :width] = np.concatenate(lows)
        del lows
        a, b = (np.ascontiguousarray(wide[:, i:i + 8]).view(np.uint64).ravel() for i in (0, 8))
        del wide
        order = np.argsort(a) if width <= 8 else np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        again = np.zeros(len(a), bool)
        again[order] = np.r_[False, same] | np.r_[same, False]
        chunk, part, bits = [], [], []
        stop = np.cumsum(sizes)
        for i, (c, p, t) in enumerate(zip(rows["chunk"].to_pylist(), rows["part"].to_pylist(), rows["twice"].to_pylist(), strict=True)):
            own = again[stop[i] - sizes[i]:stop[i]] | np.unpackbits(np.frombuffer(t, np.uint8), count=sizes[i]).astype(bool)
            if own.any():
                chunk.append(c)
                part.append(p)
                bits.append(np.packbits(own).tobytes())
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "part": pa.array(part, pa.int64()), "bits": pa.array(bits, pa.binary())})

    return run


def repeated(chunks: DataFrame, replies: DataFrame | None, hashes: Callable, groups: int, width: int, scratch: Scratch) -> DataFrame:
    """``(chunk, replies)``: which of the hashes of each chunk occur more than once in all chunks together.

    ``hashes(texts, known)`` gives the hashes of a chunk (and a second word for widths over 8 bytes); ``known`` are the
    columns of ``replies`` after the chunk. Each chunk
    sends a hash once, however often it has it, so a hash that a third of all documents have adds one entry for each
    chunk to its group; groups hold a bounded number of hashes. ``width`` bytes of the hash are compared, with the
    group's number on top.
    """
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, texts, *known = batch.columns
            for i in range(batch.num_rows):
                marks = Marks(*hashes(texts[i].as_py(), [k[i].as_py() for k in known]), groups)
                if len(marks.kinds):
                    yield marks.ask(chunk[i].as_py(), width)

    asked = with_replies(chunks.select("chunk", F.col("rows.text").alias("texts")), replies).mapInArrow(
        ask, "part long, chunk long, low binary, twice binary")
    found = asked.groupBy("part").applyInArrow(_count(width), "chunk long, part long, bits binary")
    return scratch.save(found.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("replies")))


def _count_places(rows: pa.Table) -> pa.Table:
    """Like ``_count`` with LEAD_WIDTH bytes, and which chunk has the least place of each hash."""
    sizes = [len(x) // LEAD_WIDTH for x in rows["low"].to_pylist()]
    wide = np.zeros((sum(sizes), 16), np.uint8)
    wide[:, :LEAD_WIDTH] = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(-1, LEAD_WIDTH)
    a, b = (np.ascontiguousarray(wide[:, i:i + 8]).view(np.uint64).ravel() for i in (0, 8))
    bits = lambda name: np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows[name].to_pylist(), sizes, strict=True)])
    ids, chunk = np.frombuffer(b"".join(rows["ids"].to_pylist()), np.int64), rows["chunk"].to_numpy()
    order = np.lexsort((np.repeat(chunk, sizes), ids, bits("void"), b, a))
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    again, lead = np.zeros(len(a), bool), np.zeros(len(a), bool)
    again[order] = np.r_[False, same] | np.r_[same, False]
    again |= bits("twice").astype(bool)
    lead[order] = np.r_[True, ~same]
    lead &= again
    cut = np.cumsum(sizes)[:-1]
    own = [(c, p, np.packbits(x).tobytes(), np.packbits(y).tobytes()) for c, p, x, y in zip(
        chunk.tolist(), rows["part"].to_pylist(), np.split(again, cut), np.split(lead, cut), strict=True) if x.any()]
    kinds = {"chunk": pa.int64(), "part": pa.int64(), "bits": pa.binary(), "lead": pa.binary()}
    return pa.table({k: pa.array([x[i] for x in own], t) for i, (k, t) in enumerate(kinds.items())})


def first_places(texts: DataFrame, places: Callable, groups: int, scratch: Scratch) -> DataFrame:
    """``(chunk, replies)``: like ``repeated`` with LEAD_WIDTH bytes, and which hashes have their first occurrence in the chunk.

    ``places`` gives for the columns of ``texts`` after the chunk the hashes in the order of their places, a second word
    of each, and of its document the id and whether that is null. A chunk sends the least place of each of its hashes.
    The first occurrence is the one with the smallest id, nulls last; of equal ids the one in the first chunk.
    """
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, *given = batch.columns
            for i in range(batch.num_rows):
                hashes, second, ids, void = places(*(g[i] for g in given))
                if not len(hashes):
                    continue
                marks = Marks(hashes, second, groups)
                asked, ids, void = marks.ask(chunk[i].as_py(), LEAD_WIDTH), ids[marks.first], void[marks.first]
                spans = list(zip(marks.start, marks.stop, strict=True))
                yield pa.RecordBatch.from_arrays([*asked.columns, pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()),
                                                  pa.array([np.packbits(void[a:b]).tobytes() for a, b in spans], pa.binary())],
                                                 names=[*asked.schema.names, "ids", "void"])

    asked = texts.mapInArrow(ask, "part long, chunk long, low binary, twice binary, ids binary, void binary")
    found = asked.groupBy("part").applyInArrow(_count_places, "chunk long, part long, bits binary, lead binary")
    return scratch.save(found.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits", "lead")).alias("firsts")))


def with_replies(chunks: DataFrame, replies: DataFrame | None) -> DataFrame:
    """The chunks with what is known about each; one of them is much smaller, so nothing is sorted."""
    return chunks if replies is None else chunks.join(replies.hint("shuffle_hash"), "chunk", "left")


def group_count(chunks: DataFrame) -> tuple[int, int]:
    """Groups for counts over all words, and the number of words."""
    words = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    return max(4 * partitions(chunks.sparkSession), -(-words // GROUP)), words


def narrow(words: int, groups: int) -> int:
    """Bytes with which one of a million unrepeated hashes, at most, looks repeated (a later step finds out)."""
    return min(8, max(3, -(-(max(words, 2).bit_length() + 20 - groups.bit_length() + 1) // 8)))
