"""Token counts against the tokenizers' own libraries over whole texts."""

import os
import random

import pytest

from siltline.llm import registry, token_counts
from siltline.llm.token_counts import Counter

FOLDER = "/opt/tokenizers"
SCHEMA = "doc_id long, text string, n_tokens string, n_bytes string"
NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]


def library(name):
    path = os.path.join(FOLDER, name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        return lambda x: len(t.encode(x, add_special_tokens=False).ids)
    import sentencepiece

    t = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda x: len(t.encode(x))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(8)
    parts = ["don't", "we'll", "ΑΣ", "ΣΑΣ.", "İ", "é", "́", "漢字", "한국", "<|endoftext|>", "<|startoftext|>", "<|end", "12", "3a", "--", "'s", "hello", "World",
             "​", " ", " ", "\x1c", "\x00", "ﬁ", "🙂", "x" * 60, "a.b,c", "naïve", "Ünder", "×÷"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", " ", "　", ""]
    made = ["".join(r.choice(parts) + r.choice(gaps) for _ in range(r.choice((1, 4, 60)))) for _ in range(200)]
    return [None, "", " ", "\n\n", "x", "x" * 4000, *made]


@pytest.mark.parametrize("name", NAMES)
def test_equal_to_the_library(spark, texts, name):
    count = library(name)
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", "x", "y"), (3, "\n\n", "x", "y")]
    df = token_counts.count(spark.createDataFrame(rows, SCHEMA), f"{FOLDER}/{name}", limit=40)
    want = [(i, len((t or "").encode()), n := count(t or ""), n > 40) for i, t, *_ in rows]
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want, key=repr)
    assert {r[3] for r in want} == {True, False}
    assert token_counts.count(spark.createDataFrame([], SCHEMA), f"{FOLDER}/{name}").count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_long_texts_in_stretches(texts, name, monkeypatch):
    """Small stretches, batches and memories: cut everywhere, and still the same."""
    monkeypatch.setattr(token_counts, "STRETCH", 50)
    monkeypatch.setattr(token_counts, "BATCH", 64)
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    with open(f"{FOLDER}/{name}", "rb") as f:
        own = Counter(name, f.read())
    longer = [t or "" for t in texts] + [" ".join(t for t in texts if t)]
    count = library(name)
    assert own.count(longer) == [count(t) for t in longer]
    assert len(own.known) <= 20 + 60 and sum(1 for _ in own.stretches(longer[-1])) > 20


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="json"):
        token_counts.kind_of("ranks.tiktoken", b"")


def test_query_counts_every_document(spark):
    sf = "/root/testdata/sf0.001"
    count = library(NAMES[0])
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = registry.op12_tokens(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(t.encode()), n := count(t), n > 2048) for i, t in texts.items()}
