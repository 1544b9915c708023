"""Removal of repeated word windows, found by doubling their length level by level."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.chunks import Marks, Words, group_count, narrow, packed, repeated, with_replies
from siltline.llm.common import Scratch, halves, window_hash

WINDOW = 35
#: The first level is the shortest length of at least so many words on the way to the window by doubling.
FIRST = 16
#: Bytes of the hash that decides at the last level, the number of the group not counted.
LAST_WIDTH = 12


def _levels(window: int) -> list[int]:
    return [n for n in halves(window) if n >= min(FIRST, window)]


def _candidates(words: Words, levels: list[int], known: list[list[dict] | None], groups: int) -> np.ndarray:
    """Starts at the last of the levels whose two halves are repeated at the level before it."""
    starts = words.inside(levels[-1])
    if len(levels) == 1:
        return starts
    good = np.zeros(len(words.codes) + 1, bool)
    good[_repeated(words, levels[:-1], known, groups)] = True
    return starts[good[starts] & good[starts + levels[-1] - levels[-2]]]


def _repeated(words: Words, levels: list[int], known: list[list[dict] | None], groups: int) -> np.ndarray:
    """Starts of the windows at the last of the levels that are repeated, by what is known of each level."""
    starts = _candidates(words, levels, known, groups)
    marks = Marks(window_hash(words.codes, levels[-1])[starts], np.zeros(0, np.uint64), groups)
    return starts[marks.answer(known[len(levels) - 1])]


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row ``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs(doc_id, text)``; others are not read.

    A word goes if a window of ``window`` words that covers it has the same words as a window that starts anywhere
    else, the same document included; windows are judged on the input. Windows repeated at half the length (rounded
    up) are found first; only those whose two halves are repeated are looked at in full length. Hashes, packed by
    chunk of documents and group of hashes, are what is shuffled, and a bit for each comes back. The last level
    compares 96 bits and the group's number. Null, empty and short texts have no window; repeated rows repeat each
    other; a null doc_id is as good as any; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    chunks = packed(docs.select("doc_id", "text"), scratch)
    groups, total = group_count(chunks)
    levels = _levels(window)
    replies = None
    for k, length in enumerate(levels):
        upto, last = levels[:k + 1], k + 1 == len(levels)

        def hashes(texts, known, upto=upto, length=length, last=last):
            words = Words(texts)
            starts = _candidates(words, upto, known, groups)
            return window_hash(words.codes, length)[starts], window_hash(words.codes, length, 1)[starts] if last else np.zeros(0, np.uint64)

        found = repeated(chunks, replies, hashes, groups, LAST_WIDTH if last else narrow(total, groups), scratch)
        found = found.withColumnRenamed("replies", f"level_{k}")
        replies = found if replies is None else replies.join(found, "chunk", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(1)[i].values
                words = Words(rows.field(1).to_pylist())
                hit = _repeated(words, levels, [k[i].as_py() for k in batch.columns[2:]], groups)
                step = np.zeros(len(words.codes) + 1, np.int64)
                np.add.at(step, hit, 1)
                np.add.at(step, hit + window, -1)
                gone = np.cumsum(step)[:-1] > 0
                removed, kept = [], []
                for w, a, b in zip(words.words, words.edge[:-1], words.edge[1:], strict=True):
                    own = gone[a:b]
                    removed.append(int(own.sum()))
                    if removed[-1]:
                        w = [x for x, g in zip(w, own.tolist(), strict=True) if not g]
                    kept.append(hashlib.sha256(b" ".join(w)).hexdigest())
                yield pa.RecordBatch.from_arrays([rows.field(0), pa.array(np.diff(words.edge)), pa.array(removed, pa.int64()), pa.array(kept)],
                                                 names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_replies(chunks.select("chunk", "rows"), replies).mapInArrow(finish, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
