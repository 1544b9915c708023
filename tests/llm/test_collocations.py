"""Collocations against a plain count of all runs of words."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from siltline.llm import collocations as c
from siltline.llm import registry
from siltline.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, phrase string, size string"
UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, kept, cover):
    total, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(words)
            for n in range(1, 5):
                f.update(("und" if lang is None else lang, *words[i:i + n]) for i in range(len(words) - n + 1))
    f = {k: v for k, v in f.items() if v >= least}
    out = []
    for (lang, *w), a in f.items():
        if len(w) < 2:
            continue
        cuts = [(2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k) for k in range(1, len(w))]
        longer = [v for (other, *x), v in f.items() if other == lang and len(x) > len(w) and any(x[i:i + len(w)] == w for i in range(len(x)))]
        if all(100 * v < cover * a for v in longer):
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    ranks, rows = Counter(), []
    for lang, score, a, phrase, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= kept:
            rows.append((lang, ranks[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return rows


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    words = ["Alpha", "alpha", "beta", "γάμμα", "delta", "É", "é", "x-y", "1", "naïve", "漢", "\x1c", " ", "\x00"]
    ends = [" ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "?!"]
    text = lambda n: "".join(r.choice(words) + r.choice(ends) for _ in range(n))
    out = [(i, text(r.choice((1, 8, 80))), r.choice(("en", "fr", "und", None)), "p", "s") for i in range(150)]
    out += [(200 + i, "one two three four five", "en", "p", "s") for i in range(12)]
    out += [(300, None, "en", "p", "s"), (301, "", "de", "p", "s"), (302, ".,;", "de", "p", "s"), (303, "a b " * 4000, "es", "p", "s"), (None, "one two", None, "p", "s")]
    return out + [out[0], out[0]]


@pytest.mark.parametrize(("least", "kept", "cover"), [(5, 2000, 80), (2, 7, 30), (30, 3, 101)])
def test_equal_to_brute_force(spark, rows, least, kept, cover):
    df = c.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least, kept, cover)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, df.collect())) == sorted(brute(rows, least, kept, cover))


def test_small_chunks_count_together(spark, rows):
    """Chunks of a few hundred characters: nothing is frequent in any of them alone. Numbered here, as workers have constants of their own."""
    docs = [(lang or "und", [t or ""]) for _, t, lang, *_ in rows]
    chunks = []
    for i, (lang, texts) in enumerate(docs):
        words, number, begins = c.split_words("\n".join(texts).encode())
        chunks.append((i, lang, b" ".join(words), np.where(begins, ~number, number).astype("<i4").tobytes(), len(number)))
    frame = spark.createDataFrame(chunks, "chunk long, lang string, words binary, numbers binary, n_words long")
    got = {(r.lang, *r.phrase.split(" ")): r.f for r in c.frequent_phrases(frame, 5, Scratch(spark, "test")).collect()}
    f = Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^\x20\x09]+", piece)
            for n in range(1, 5):
                f.update(("und" if lang is None else lang, *words[i:i + n]) for i in range(len(words) - n + 1))
    assert got == {k: v for k, v in f.items() if v >= 5}


def test_nothing_to_find(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert c.collocations(spark.createDataFrame([(1, None, None, "p", "s"), (2, "", "en", "p", "s"), (3, "few words", "en", "p", "s")], SCHEMA)).count() == 0


def test_fingerprints_depend_on_the_run_only():
    values = np.random.default_rng(2).integers(0, 1 << 63, 50, dtype=np.uint64)
    p = c.prefix(np.r_[values, np.uint64(7), values])
    one, two = (c.spans(p, np.array([k]), np.array([k + 20])) for k in (10, 61))
    assert one == two != c.spans(p, np.array([11]), np.array([31]))


def test_colliding_fingerprints_are_told_apart_by_text(monkeypatch):
    data = b"Some words, some OTHER words: other"
    words, number, begins = c.split_words(data)
    plain = [words[i] for i in number]
    assert plain == [b"some", b"words", b"some", b"other", b"words", b"other"] and begins.tolist() == [True, False, True, False, False, True]
    grams = c.Grams("en", b" ".join(words), np.where(begins, ~number, number).astype("<i4").tobytes())
    want = sorted(grams.phrases(grams.starts(2), 2))
    monkeypatch.setattr(c, "spans", lambda p, a, b: np.zeros(len(a), np.uint64))  # all runs collide
    again, number, _ = c.split_words(data)
    assert [again[i] for i in number] == plain
    assert sorted(grams.phrases(grams.starts(2), 2)) == want == [(b"other words", 1), (b"some other", 1), (b"some words", 1)]


def test_long_texts_are_cut_where_pieces_end(monkeypatch):
    monkeypatch.setattr(c, "CHARS", 20)
    text = "a b c. d e f, " * 9 + "x" * 50
    parts = list(c._parts(text))
    assert len(parts) > 4 and [w for p in parts for w in re.split("[ .,]+", p) if w] == [w for w in re.split("[ .,]+", text) if w]


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    want = con.execute(registry.ORACLES["op13_collocations"]).fetchall()
    assert sorted(map(tuple, registry.op13_collocations(spark, sf).collect())) == sorted(want) and len(want) > 100
