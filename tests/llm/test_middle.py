"""Fill-in-middle against plain slices."""

import hashlib
import random

import numpy as np
import pytest

from siltline.llm import middle, registry
from siltline.llm.middle import Units, chunk_edges

SCHEMA = "doc_id long, text string, form string, n string"


def plain_slices(doc_id, text, unit="char", rate=90, suffix_first=20):
    text = text or ""
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[i:i + 8], 16) for i in range(0, 32, 8)]
    if unit == "char":
        begins = list(range(len(text)))
    else:
        space = "\x20\t\n\x0b\x0c\r"
        begins = [i for i, c in enumerate(text) if c not in space and (i == 0 or text[i - 1] in space)]
    n = len(begins)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    at = [0 if k == 0 else len(text) if k == n else begins[k] for k in (a, b)]
    p, m, s = text[:at[0]], text[at[0]:at[1]], text[at[1]:]
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    letters = "abc déü 漢字🙂\n\t é"
    shared = "".join(r.choice(letters) for _ in range(6000))
    texts = [None, "", " ", "x", "🙂", "a<P>b", "<", "<<S", ">M>", "P><S", "<M>", "é" * 3000, " lead", "trail ", "\n\n", "x" * 50_000]
    texts += ["".join(r.choice(letters) for _ in range(r.choice((5, 80, 3000, 9000)))) for _ in range(60)]
    texts += [shared + t for t in texts[-20:] if t] + ["<" * 40 + "S>" * 20]
    out = [(i, t, "x", "y") for i, t in enumerate(texts)]
    return out + [(None, "no id at all", "x", "y"), out[20], out[20], (5, "same id, other text", "x", "y")]


@pytest.mark.parametrize("unit", ["char", "word"])
def test_equal_to_slices(spark, rows, unit):
    got = sorted((tuple(x) for x in middle.transform(spark.createDataFrame(rows, SCHEMA), unit=unit).collect()), key=repr)
    assert got == sorted(((i, *plain_slices(i, t, unit)) for i, t, *_ in rows), key=repr)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}


def test_restored_and_digests(spark, rows):
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    df = middle.digests(spark.createDataFrame(rows, SCHEMA))
    assert df.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = []
    for i, t, *_ in rows:
        n, form, a, b, out = plain_slices(i, t)
        want.append((i, n, form, a, b, digest(out), digest(t or "")))
    assert sorted((tuple(x) for x in df.collect()), key=repr) == sorted(want, key=repr)
    assert middle.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rates(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.form for r in middle.transform(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in middle.transform(docs, rate=100, suffix_first=100).collect()} == {"plain", "spm"}


@pytest.mark.parametrize("room", [0, 3000, 1 << 20])
@pytest.mark.parametrize("unit", ["char", "word"])
def test_a_small_memory_changes_nothing(rows, unit, room):
    units = Units(unit, room)
    for _ in range(2):
        for i, t, *_ in rows:
            assert middle.arranged(units, i, t or "", 90, 20, "1") == plain_slices(i, t, unit)
    assert units.held <= max(room, 1 << 16)
    assert room < 1 << 20 or units.hits > len(rows)


def test_chunks_depend_on_content_only(monkeypatch):
    r = np.random.default_rng(1)
    body, a, b = (r.integers(0, 256, n, dtype=np.uint8) for n in (40_000, 777, 5001))
    ends = [set((np.array(chunk_edges(np.r_[head, body])) - len(head)).tolist()) for head in (a, b)]
    inside = [{e for e in x if e >= middle.WINDOW} for x in ends]
    assert inside[0] == inside[1] and len(inside[0]) > 20
    whole = chunk_edges(body)
    monkeypatch.setattr(middle, "BLOCK", 1000)  # a long text is hashed block by block
    assert chunk_edges(body) == whole
    assert chunk_edges(body[:0]) == [] and chunk_edges(body[:1]) == [1]


def test_sql_and_query(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    want = con.execute(f"select doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 from ({registry.OP11})").fetchall()
    assert sorted(map(tuple, registry.op11_middle(spark, sf).collect())) == sorted(want)
