"""Repeated passages from sparse suffixes at minimiser positions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.chunks import Marks, Words, first_places, group_count, packed, repeated, with_replies
from siltline.llm.common import Scratch, mix, window_hash

#: A passage has so many words at least. Suffixes start at minimisers: of any REACH word runs of GRAM words in a row the
#: one with the smallest hash; a passage holds REACH such runs, so its occurrences have a minimiser in common.
PASSAGE, GRAM = 50, 20
REACH = PASSAGE - GRAM + 1
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def minimisers(words: Words) -> np.ndarray:
    """Selected positions of a chunk, in order; ties go to the first of equal hashes."""
    starts = words.inside(PASSAGE)  # first run of a stretch of REACH runs in one document
    if not len(starts):
        return starts
    value = mix(window_hash(words.codes, GRAM) ^ np.uint64(0x5EED))
    best = np.arange(len(value))
    span = 1  # smallest over spans that double, then two overlapping ones
    while 2 * span <= REACH:
        far = best[span:]
        near = best[:len(far)]
        best = np.where(value[far] < value[near], far, near)
        span *= 2
    far, near = best[starts + REACH - span], best[starts]
    return np.unique(np.where(value[far] < value[near], far, near))


def _windows(words: Words, known: list[dict] | None, groups: int) -> np.ndarray:
    """Starts of the windows of PASSAGE words around the minimisers whose first GRAM words are repeated."""
    spots = minimisers(words)
    spots = spots[Marks(window_hash(words.codes, GRAM)[spots], np.zeros(0, np.uint64), groups).answer(known)]
    begin = words.edge[np.searchsorted(words.edge, spots, "right") - 1]
    first, last = np.maximum(begin, spots - REACH + 1), np.minimum(spots, spots + words.left[spots] - PASSAGE)
    step = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, last + 1, -1)
    return np.flatnonzero(np.cumsum(step)[:-1] > 0)


def _places(words: Words, ids: pa.Array, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts in the order of their documents (smallest id, nulls last, then place); two hashes of each window, and the
    ids of the documents and whether they are null."""
    void, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.cast(pa.int64()).fill_null(0).to_numpy()
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((ids, void))] = np.arange(len(ids))
    item = np.searchsorted(words.edge, starts, "right") - 1
    order = np.argsort(rank[item], kind="stable")
    starts, item = starts[order], item[order]
    return starts, window_hash(words.codes, PASSAGE)[starts], window_hash(words.codes, PASSAGE, 1)[starts], ids[item], void[item]


def _covering(n: int, starts: np.ndarray) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + PASSAGE, -1)
    return np.cumsum(step)[:-1] > 0


def passages(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """The chunks of ``docs``, ``(chunk, replies, firsts)`` with what is known of their 20-word runs and of their windows,
    and the groups of the hashes.

    Suffixes whose first ``GRAM`` words occur once are left out. Two occurrences of a window of ``PASSAGE`` words have
    the same minimiser, so all repeated windows lie around the suffixes that are left, at most ``REACH`` around each.
    Those are counted by 96 bits of their hash, and the first occurrence (smallest doc_id, nulls last, then place) is
    chosen for each window: a run of ``GRAM`` words may lie in many different passages. A window that a third of all
    documents have adds one entry for each chunk.
    """
    at = [c.lower() for c in docs.columns].index("doc_id")
    chunks = packed(docs, scratch)
    groups, _ = group_count(chunks)

    def hashes(texts, _known):
        words = Words(texts)
        return window_hash(words.codes, GRAM)[minimisers(words)], np.zeros(0, np.uint64)

    replies = repeated(chunks, None, hashes, groups, 8, scratch)

    def places(texts, ids, known):
        words = Words(texts.as_py())
        return _places(words, ids.values, _windows(words, known.as_py(), groups))[1:]

    texts = chunks.select("chunk", F.col("rows.text").alias("texts"), F.col("rows").getField(docs.columns[at]).alias("ids"))
    firsts = first_places(texts.join(replies.hint("shuffle_hash"), "chunk"), places, groups, scratch)
    return chunks, replies.join(firsts, "chunk"), groups


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _without(text: str, mask: np.ndarray) -> str:
    """The text without the marked words and the white space after them."""
    raw = text.encode()
    begin = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    out, last = [], 0
    for a, b in _runs(mask):
        out.append(raw[last:begin[a]])
        last = begin[b]
    return b"".join([*out, raw[last:]]).decode()


def _by_document(texts: list[str | None], ids: pa.Array, known: list[dict] | None, firsts: list[dict] | None, groups: int) -> Iterator[tuple[str | None, int, np.ndarray, np.ndarray]]:
    """Text, words, words in repeated passages and words to remove: those of later windows, unless they are words of a
    first one too. So each window that is repeated stays whole where it occurs first."""
    if not firsts:
        for text in texts:
            n = len((text or "").encode().split())
            yield text, n, np.zeros(n, bool), np.zeros(n, bool)
        return
    words = Words(texts)
    starts, value, second, *_ = _places(words, ids, _windows(words, known, groups))
    marks = Marks(value, second, groups)
    again, lead = marks.answer(firsts), marks.leads(firsts)
    inside = _covering(len(words.codes), starts[again])
    gone = _covering(len(words.codes), starts[again & ~lead]) & ~_covering(len(words.codes), starts[lead])
    for text, a, b in zip(texts, words.edge[:-1], words.edge[1:], strict=True):
        yield text, int(b - a), inside[a:b], gone[a:b]


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_repeated, n_removed, repeated, removed, kept_sha256``.

    ``repeated`` lists the ranges ``(start, stop)`` of words that lie in a passage of at least ``PASSAGE`` words found
    elsewhere too; ``removed`` those in a window of ``PASSAGE`` words of which an earlier occurrence stays, and in none
    that occurs here first; the digest is of the words that stay, joined
    by one space. Null and short texts have no passage; repeated rows are occurrences like all others; other columns
    are not read.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    chunks, known, groups = passages(docs.select("doc_id", "text"), scratch)
    ranges = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(0)[i].values
                out = []
                for text, n, again, gone in _by_document(rows.field(1).to_pylist(), rows.field(0), *(c[i].as_py() for c in batch.columns[1:]), groups):
                    words = (text or "").encode().split()
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words
                    out.append((n, int(again.sum()), int(gone.sum()), *([{"start": a, "stop": b} for a, b in _runs(x)] for x in (again, gone)),
                                hashlib.sha256(b" ".join(kept)).hexdigest()))
                types = [pa.int64()] * 3 + [ranges] * 2 + [pa.string()]
                yield pa.RecordBatch.from_arrays([rows.field(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))],
                                                 names=["doc_id", "n_words", "n_repeated", "n_removed", "repeated", "removed", "kept_sha256"])

    kind = "array<struct<start:int,stop:int>>"
    return with_replies(chunks.select("chunk", "rows"), known).drop("chunk").mapInArrow(
        finish, f"doc_id long, n_words long, n_repeated long, n_removed long, repeated {kind}, removed {kind}, kept_sha256 string")


def drop_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the words of later occurrences of repeated passages, in the columns of ``docs``; ``n_chars`` is counted
    anew. Texts without such a passage stay as they are; a document of which no word is left is dropped."""
    scratch = Scratch(docs.sparkSession, "passages-drop")
    chunks, known, groups = passages(docs, scratch)
    names = [c.lower() for c in docs.columns]
    at, own_id, length = names.index("text"), names.index("doc_id"), names.index("n_chars") if "n_chars" in names else None

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, texts, keep = batch.column(0)[i].values, [], []
                for text, n, _again, gone in _by_document(rows.field(at).to_pylist(), rows.field(own_id), *(c[i].as_py() for c in batch.columns[1:]), groups):
                    keep.append(not n or not gone.all())
                    texts.append(_without(text, gone) if gone.any() else text)
                columns = rows.flatten()
                changed = pa.array([a != b for a, b in zip(texts, columns[at].to_pylist(), strict=True)])
                columns[at] = pa.array(texts, columns[at].type)
                if length is not None:
                    sizes = pa.array([None if t is None else len(t) for t in texts], columns[length].type)
                    columns[length] = pa.compute.if_else(changed, sizes, columns[length])
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in rows.type]).filter(pa.array(keep))

    return with_replies(chunks.select("chunk", "rows"), known).drop("chunk").mapInArrow(finish, docs.schema)
