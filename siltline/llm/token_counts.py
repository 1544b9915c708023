"""Token counts of whole texts, by batches of equal size in bytes."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import prepare

TOKENIZER = os.environ.get("SILTLINE_TOKENIZER", "/opt/tokenizers/word_bpe_49k.json")
LIMIT = 2048
#: Characters of a stretch of a long text, at least; bytes that are encoded in one call, about.
STRETCH, BATCH = 1 << 20, 1 << 18
#: A worker remembers the lengths of so many segments of up to so many characters.
REMEMBERED, SHORT = 400_000, 48
#: Characters that compose with nothing before them, so that normal forms do not reach across.
_OPEN = "!-~À-ÖØ-öø-ÿΑ-Ρα-ωА-я一-鿿"
#: Where a text may be cut without a change of its tokens, by kind of tokenizer; what a match holds belongs to no side.
SAFE = {
    # White space ends every token and is dropped.
    "words": re.compile(f"[ \\t\\n\\r]+(?=[{_OPEN}])"),
    # A single space belongs to the word behind it.
    "bytes": re.compile("(?<=[A-Za-z0-9])(?= [A-Za-z])"),
    # A single space is the mark that begins the next part, as it begins a text; no piece has one inside.
    "pieces": re.compile("(?<=[A-Za-z0-9,.;:!?]) (?=[A-Za-z0-9])"),
}


def kind_of(name: str, content: bytes) -> str:
    """The rule for safe boundaries that fits a tokenizer file."""
    if name.endswith(".model"):
        return "pieces"
    if not name.endswith(".json"):
        raise ValueError(f"{name}: a .json file or a .model file is needed")
    return "words" if json.loads(content)["model"].get("end_of_word_suffix") else "bytes"


class Counter:
    """Numbers of tokens of texts. Texts are cut at safe boundaries into segments whose tokens add up; a segment met
    before isn't encoded again."""

    def __init__(self, name: str, content: bytes):
        self.safe, self.known = SAFE[kind_of(name, content)], {}
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            if any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size())):
                raise ValueError(f"{name}: pieces run across spaces")
            self._lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(content.decode())
            model.no_truncation()
            model.no_padding()
            self._lengths = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]

    def lengths(self, texts: list[str]) -> list[int]:
        """Lengths of encoded texts; a call holds about BATCH bytes."""
        out, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t.encode())
            if size >= BATCH:
                out += self._lengths(held)
                held, size = [], 0
        return out + self._lengths(held) if held else out

    def stretches(self, text: str) -> Iterator[str]:
        """A text in stretches of about STRETCH characters, each ended at a safe boundary."""
        at = 0
        while len(text) - at > STRETCH and (cut := self.safe.search(text, at + STRETCH)):
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; texts are taken together, or cut, to about STRETCH characters."""
        totals, held, size = [0] * len(texts), [], 0
        for i, t in enumerate(texts):
            for s in self.stretches(t):
                held.append((i, self.safe.split(s)))
                size += len(s)
                if size >= STRETCH:
                    self._add(held, totals)
                    held, size = [], 0
        self._add(held, totals)
        return totals

    def _add(self, held: list[tuple[int, list[str]]], totals: list[int]) -> None:
        known = self.known
        fresh = list({s: None for _, segments in held for s in segments if s not in known})
        lengths = dict(zip(fresh, self.lengths(fresh), strict=True))
        for i, segments in held:
            totals[i] += sum([known[s] if s in known else lengths[s] for s in segments])
        if len(known) + len(lengths) > REMEMBERED:
            known.clear()
        known.update((s, n) for s, n in lengths.items() if len(s) <= SHORT)


def count(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs(doc_id, text)``.

    ``n_tokens`` is what the tokenizer's own library gives for the whole text, without begin, end or added special tokens;
    strings of special tokens inside a text count as the library's default has them. ``over_limit`` says whether that is more than
    ``limit``. Encoding runs inside Arrow batches; only lengths come back. A long text is cut into stretches and those into
    segments at boundaries that no token crosses; calls of the library hold about ``BATCH`` bytes, whatever the
    lengths of the texts. A null text counts as empty, repeated rows give equal results, an empty table no rows; other
    columns are not read. The file is read once, on the driver, and broadcast (a few MB). No shuffle.
    """
    spark = prepare(docs.sparkSession)
    with open(tokenizer, "rb") as f:
        shared = spark.sparkContext.broadcast((os.path.basename(tokenizer), f.read()))
    own: list[Counter] = []

    def run(texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Counter(*shared.value))
        return pa.array(np.array(own[0].count([t or "" for t in texts.to_pylist()]), np.int64))

    n = F.arrow_udf(run, "long")(F.col("text"))
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n.alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
