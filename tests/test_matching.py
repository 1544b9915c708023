"""Phrases and near keys against comparing every pair."""

import random
import re

import pytest

from siltline.operators.near_keys import near_keys
from siltline.operators.phrases import match_phrases
from tests.conftest import plan_of, tuples

TEXTS = "n int, value string, label string, `a.b` string"


def test_phrases(spark):
    r = random.Random(4)
    words = ["soja", "Maní", "TRIGO", "grano", "partido", "de", "aceite", "x1"]
    sep = [" ", "  ", "-", ", ", "_", " (", "/"]
    text = lambda n: "".join(r.choice(words) + r.choice(sep) for _ in range(n))
    rows = [(i, text(r.randrange(0, 7)), "own", "c") for i in range(150)]
    rows += [(200 + i, "Grano de Maní Partido Blancheado", "own", "c") for i in range(80)] + [(300, None, "own", "c"), (301, "sojas manía", "own", "c"), (302, "--", "own", "c")]
    dictionary = [("soja", "oil"), ("SOJA ", "bean"), ("aceite de soja", "oil"), ("mani partido", "nut"), ("grano de", "grain"), ("de grano", "of grain"),
                  ("trigo", "wheat"), (None, "none"), ("", "empty"), ("!!", "mark"), ("x1", None), ("de", "of")]
    plain = lambda s: re.sub(r"[\W_]+", " ", s.lower().replace("í", "i").replace("ñ", "n")).strip()
    known = {}
    for p, label in dictionary:
        if p is not None and label is not None and plain(p):
            known[plain(p)] = min(label, known.get(plain(p), label))

    def label_of(value):
        if value is None:
            return "Other"
        hits = [(-len(p.split()), f" {plain(value)} ".find(f" {p} "), label) for p, label in known.items() if f" {p} " in f" {plain(value)} "]
        return min(hits)[2] if hits else "Other"

    df = match_phrases(spark.createDataFrame(rows, TEXTS), "value", spark.createDataFrame(dictionary, "phrase string, label string"), "phrase", "label", "found", "Other")
    assert df.columns == ["n", "value", "label", "a.b", "found"]
    assert tuples(df) == sorted([(*row, label_of(row[1])) for row in rows], key=repr)
    assert {row[4] for row in tuples(df)} >= {"bean", "nut", "grain", "of grain", "wheat", "Other"}
    plan = plan_of(df)
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_phrases_of_an_empty_dictionary_or_table(spark):
    rows, none = spark.createDataFrame([(1, "soja", "own", "c")], TEXTS), spark.createDataFrame([], "phrase string, label string")
    assert tuples(match_phrases(rows, "value", none, "phrase", "label", "found")) == [(1, "soja", "own", "c", None)]
    assert match_phrases(rows.limit(0), "value", none, "phrase", "label", "found").count() == 0


def edits(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_near_keys_miss_no_pair(spark, distance):
    r = random.Random(distance)
    alphabet = "abcñ "
    base = ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 14))) for _ in range(70)] + ["common prefix " + str(i) for i in range(40)] + ["aaaaaaaa", "aaaaaaaaaa", "ab" * 6]

    def damaged(s):
        for _ in range(r.randrange(0, 4)):
            i = r.randrange(0, len(s) + 1)
            s = r.choice((s[:i] + r.choice(alphabet) + s[i:], s[:i] + s[i + 1:], s[:i] + r.choice(alphabet) + s[i + 1:]))
        return s

    known = base + base[:5] + [None]
    asked = [damaged(r.choice(base)) for _ in range(150)] + [None, "", "nothing like it at all"]
    want = []
    for a in {a for a in asked if a is not None}:
        near = [(d, b.encode(), b) for b in {b for b in known if b is not None} if (d := edits(a, b)) <= distance]
        if near:
            want.append((a, min(near)[2], min(near)[0]))
    frames = [spark.createDataFrame([(x,) for x in side], "k string") for side in (asked, known)]
    df = near_keys(frames[0], "k", frames[1], "k", distance)
    assert tuples(df) == sorted(want, key=repr) and len(want) > 50
    plan = plan_of(df)
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert near_keys(frames[0].limit(0), "k", frames[1], "k", distance).count() == 0
    assert near_keys(frames[0], "k", frames[1].limit(0), "k", distance).count() == 0
