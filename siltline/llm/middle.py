"""Fill-in-middle transformation of whole texts, cut where chunk counts say."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import mix, prepare

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of the texts that are transformed, and of those that get the suffix first; the seed of the choices.
RATE, SUFFIX_FIRST, SEED = 90, 20, "1"
#: A chunk ends where the top bits of the rolling hash of the last WINDOW bytes are zero: about every 2 ** CUT_BITS bytes.
WINDOW, CUT_BITS = 32, 10
#: Bytes that are hashed at once, bytes of chunks that a worker remembers, and the longest chunk worth remembering.
BLOCK, REMEMBERED, LONGEST = 1 << 22, 1 << 26, 1 << 16
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def chunk_edges(raw: np.ndarray) -> list[int]:
    """Ends of the content-defined chunks of a text; the last one is its length. They depend on the WINDOW bytes before
    each end only, so equal stretches of different texts fall into equal chunks."""
    out = []
    for at in range(0, len(raw), BLOCK):
        begin = max(0, at - WINDOW + 1)
        h, span = _GEAR[raw[begin:at + BLOCK]], 1
        while span < WINDOW:  # the hash of 2 * span bytes from those of span bytes
            h[span:] += h[:-span] << np.uint32(span)
            span *= 2
        ends = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + begin + 1
        out.append(ends[(ends > max(at, WINDOW - 1)) & (ends < len(raw))])
    return [*np.concatenate(out).tolist(), len(raw)] if out else []


def _starts(raw: np.ndarray, unit: str, after_space: bool) -> np.ndarray:
    """Which bytes begin a unit: a code point, or a word with the white space behind it."""
    if unit == "char":
        return (raw & 0xC0) != 0x80
    space = _SPACE[raw]
    return ~space & np.r_[after_space, space[:-1]]


class Units:
    """Counts and places of the units of texts. Chunks that were met before are recognised by their whole content, and
    answer with their summary: units if the byte before them is white space, whether one fewer begins if it isn't, and
    whether they end in white space. Summaries of neighbours add up, so a chunk may begin inside a unit."""

    def __init__(self, unit: str = "char", remembered: int = REMEMBERED):
        self.unit, self.room, self.held, self.known = unit, remembered, 0, {}
        self.hits = 0

    def _summary(self, chunk: bytes) -> tuple[int, int, bool]:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        raw = np.frombuffer(chunk, np.uint8)
        begins = _starts(raw, self.unit, True)
        found = int(np.count_nonzero(begins)), int(self.unit != "char" and bool(begins[0])), bool(_SPACE[raw[-1]])
        if len(chunk) <= LONGEST:
            if self.held + len(chunk) > self.room:
                self.known.clear()
                self.held = 0
            self.known[chunk] = found
            self.held += len(chunk)
        return found

    def read(self, data: bytes) -> tuple[list[int], list[int], list[bool]]:
        """Ends of the chunks, units up to each of them, and whether each ends in white space."""
        edges, total, after_space = chunk_edges(np.frombuffer(data, np.uint8)), 0, True
        counts, spaces, last = [], [], 0
        for end in edges:
            n, fewer, space = self._summary(data[last:end])
            total += n if after_space else n - fewer
            counts.append(total)
            spaces.append(space)
            after_space, last = space, end
        return edges, counts, spaces

    def offset(self, data: bytes, read: tuple, k: int) -> int:
        """The byte before which ``k`` units end."""
        edges, counts, spaces = read
        if k <= 0:
            return 0
        if not counts or k >= counts[-1]:
            return len(data)
        c = int(np.searchsorted(counts, k, "right"))
        begin = edges[c - 1] if c else 0
        raw = np.frombuffer(data, np.uint8)[begin:edges[c]]
        begins = np.flatnonzero(_starts(raw, self.unit, spaces[c - 1] if c else True))
        return begin + int(begins[k - (counts[c - 1] if c else 0)])


def draws(seed: str, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that decide about a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def arranged(units: Units, doc_id: int | None, text: str, rate: int, suffix_first: int, seed: str) -> tuple:
    """``(n, form, units of the prefix, units of the middle, output)`` of one text."""
    data = text.encode()
    read = units.read(data)
    n = read[1][-1] if read[1] else 0
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (units.offset(data, read, k) for k in (first, second))
    prefix, middle, suffix = (x.decode() for x in (data[:a], data[a:b], data[b:]))
    if h4 % 100 < suffix_first:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


_KINDS = {"n": pa.int64(), "form": pa.string(), "prefix_units": pa.int64(), "middle_units": pa.int64(), "output": pa.string()}


def transform(docs: DataFrame, unit: str = "char", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """``(doc_id, n, form, prefix_units, middle_units, output)`` for every row of ``docs(doc_id, text)``.

    A text of ``n`` units (``char``: code points; ``word``: words ``[^\\x20\\x09-\\x0D]+``, each with the white space behind
    it) is cut twice, at places that a hash of the seed and the doc_id gives, and put together as prefix, suffix, middle
    (``psm``) or suffix, prefix, middle (``spm``) with a mark before each. Texts that are empty, that contain one of the
    marks, or that the hash leaves out stay as they are (``plain``, units null). The places are found by content-defined
    chunks, whose counts a worker remembers; a text of any length is cut whole. A null text counts as empty, a null
    doc_id as an empty one, repeated rows give equal results, an empty table no rows; other columns are not read. No
    shuffle.
    """
    if unit not in ("char", "word"):
        raise ValueError(f"unit is char or word, not {unit!r}")
    prepare(docs.sparkSession)
    own: list[Units] = []

    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Units(unit))
        rows = [arranged(own[0], i.as_py(), t.as_py() or "", rate, suffix_first, seed) for i, t in zip(ids, texts, strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * len(_KINDS)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS.values(), strict=True)], names=list(_KINDS))

    made = F.arrow_udf(run, "struct<n:long,form:string,prefix_units:long,middle_units:long,output:string>")
    return docs.select("doc_id", made(F.col("doc_id"), F.col("text")).alias("x")).select("doc_id", "x.*")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A mark occurs in no part, so the first one found is the one put there."""
    body = F.substr(output, F.lit(4))
    one = F.split_part(body, F.when(form == "psm", SUFFIX).otherwise(PREFIX), F.lit(1))
    rest = F.substr(body, F.char_length(one) + 4)
    two = F.split_part(rest, F.lit(MIDDLE), F.lit(1))
    middle = F.substr(rest, F.char_length(two) + 4)
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` with the units code points."""
    made = transform(docs)
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
