"""The pipeline stage by stage on odd documents."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from siltline.llm import language, mixing, pieces, simhash, suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, row map<string,int>, component_id int"


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(9)
    kinds = [[f"{a}{b}{c}" for a in "bdfg" for b in vowels for c in "lmnr"] for vowels in ("ae", "ou", "iy")]
    prose = lambda k, n: " ".join(r.choice(kinds[k]) for _ in range(n))
    shared = prose(0, 70)
    out = [(i, prose(i % 3, 150), "xyz"[i % 3], ("s1", "s2", None)[i % 3]) for i in range(40)]
    out += [(50 + i, f"{prose(0, 60)} {shared}\n{prose(0, 60)}", "x", "s1") for i in range(5)]
    out += [(60 + i, out[3][1], "x", "s2") for i in range(6)] + [(70, None, "x", "s1"), (71, "", "x", "s1"), (72, "1 2 3", "y", "s1"), (None, prose(1, 90), None, "s1")]
    out += [(80, prose(2, 9000), "z", "s2"), out[1], out[1]]
    return spark.createDataFrame([(*x, None if x[1] is None else len(x[1]), "dotted", {"k": 1}, 7) for x in out], SCHEMA)


def test_stages(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "mixing sources", "SentencePiece encoding"]
    now = docs
    rows_of = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = rows_of(now), stage(spark, now, "")
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        got = rows_of(after)
        if name == "language ID":
            learned = language.profiles(now.where(~language.held_out()))
            found = zip(before, *language.predict(learned, [t for _, t in before]), strict=True)
            assert Counter(got) == Counter(row for row, lang, score in found if lang != "und" and score >= language.LEAST_SCORE)
            assert {70, 71, 72}.isdisjoint(i for i, _ in got) and len(got) > 50
        elif name == "SimHash near-dedup":
            prints = {row: simhash.fingerprint(row[1]) for row in before}
            label = {row: row for row in prints}
            order = lambda row: (row[0] is None, row[0] or 0, row[1] or "")
            for _ in range(6):
                label = {a: min((label[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3), key=order) for a in prints}
            assert Counter(i for i, _ in got) == Counter(x[0] for x in set(label.values())) and set(got) <= set(before)
        elif name == "suffix-array dedup":
            windows = Counter(tuple(w[i:i + 50]) for _, t in got for w in [t.split()] for i in range(len(w) - 49))
            assert max(windows.values()) == 1 and len(got) == len(before)
        else:
            taken = Counter()
            for r in mixing.mixed(now)[0].collect():
                taken[r.source] += r.taken
            words = Counter()
            for r in after.collect():
                words[r.source] += len(r.text.split())
            assert words == +taken
        now = after
    last = corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
    with open(pieces.MODEL, "rb") as f:
        plain = pieces.Pieces(f.read())
    assert Counter((r.doc_id, r.decoded) for r in last) == Counter(rows_of(now))
    assert all(plain.decode(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.decoded for r in last[:5])


def test_run(spark, docs, tmp_path):
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() > 40
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert suffix_array.drop_passages(docs).columns == docs.columns
