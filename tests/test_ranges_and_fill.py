"""Merged and missing date ranges, and readings filled day by day, against loops over days."""

import random
from datetime import date, timedelta

import pytest

from siltline.operators.fill import filled_days
from siltline.operators.intervals import merged_ranges, missing_ranges
from tests.conftest import plan_of, tuples

D0 = date(2024, 1, 1)
DAY = timedelta(days=1)
RANGES = "id string, first date, last date, other int"


def some_ranges(seed):
    """A third of the rows on one key; touching, nested, repeated, reversed and null ranges."""
    r = random.Random(seed)
    rows = []
    for i in range(120):
        first = D0 + DAY * r.randrange(0, 300)
        rows.append(("hot" if i % 3 == 0 else r.choice(["a", "b", "c", None]), r.choice((first, first, first, None)), r.choice((first + DAY * r.randrange(-3, 20), first, None)), i))
    return rows + rows[:4] + [("t", D0, D0 + DAY, 0), ("t", D0 + 2 * DAY, D0 + 3 * DAY, 0), ("t", D0 + 5 * DAY, D0 + 5 * DAY, 0)]


def covered(rows):
    days = {}
    for key, a, b, _ in rows:
        if key is not None and a and b:
            while a <= b:
                days.setdefault(key, set()).add(a)
                a += DAY
    return days


def runs(days):
    out = []
    for d in sorted(days):
        if out and out[-1][1] + DAY == d:
            out[-1][1] = d
        else:
            out.append([d, d])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_and_missing(spark, seed):
    rows = some_ranges(seed)
    df = spark.createDataFrame(rows, RANGES)
    days = covered(rows)
    assert tuples(merged_ranges(df, ["id"], "first", "last")) == sorted([(k, *r) for k, d in days.items() for r in runs(d)], key=repr)
    lo, hi = D0 + 40 * DAY, D0 + 200 * DAY
    wanted = spark.createDataFrame([("hot",), ("a",), ("a",), ("t",), ("nothing landed",)], "id string")
    every = {lo + DAY * i for i in range((hi - lo).days + 1)}
    want = [(k, *r) for k in ("hot", "a", "t", "nothing landed") for r in runs(every - days.get(k, set()))]
    assert tuples(missing_ranges(wanted, df, ["id"], "first", "last", lo, hi)) == sorted(want, key=repr)


def test_empty_and_inverted_windows(spark):
    none, some = spark.createDataFrame([], RANGES), spark.createDataFrame(some_ranges(3), RANGES)
    wanted = spark.createDataFrame([("a",)], "id string")
    assert merged_ranges(none, ["id"], "first", "last").count() == 0
    assert tuples(missing_ranges(wanted, none, ["id"], "first", "last", D0, D0)) == [("a", D0, D0)]
    assert missing_ranges(wanted, some, ["id"], "first", "last", D0, D0 - DAY).count() == 0
    assert missing_ranges(wanted.limit(0), some, ["id"], "first", "last", D0, D0).count() == 0
    plan = plan_of(missing_ranges(wanted, some, ["id"], "first", "last", D0, D0 + 9 * DAY))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


READINGS = "place string, day date, heat int, `rain` string, note string"


@pytest.mark.parametrize(("age", "span"), [(3, 5), (3, 366), (0, 7), (1000, 10)])
def test_filled_days(spark, age, span):
    r = random.Random(age + span)
    rows = [(r.choice(["hot", "hot", "a", "b", None]), r.choice([D0 + DAY * r.randrange(0, 150), D0 + DAY * r.randrange(0, 9), None]),
             r.choice([None, 1, 2, 3]), r.choice([None, "x", "y"]), "n") for _ in range(90)]
    rows += rows[:3] + [("one", D0, None, "z", "n")]
    first = {}
    for place, day, heat, rain, _ in rows:
        if place is not None and day is not None:
            now = (heat is not None, heat or 0, rain is not None, rain or "", heat, rain)
            first[place, day] = min(first.get((place, day), now), now)
    want = []
    for place in {p for p, _ in first}:
        days = [d for p, d in first if p == place]
        day, last = min(days), {}
        while day <= max(days):
            own = first.get((place, day), (None,) * 6)[4:]
            line = []
            for k, v in enumerate(own):
                if v is not None:
                    last[k] = (day, v)
                standing = last.get(k)
                line.append(standing[1] if standing and (day - standing[0]).days <= age else None)
            want.append((place, day, *line, *[own[k] is None and line[k] is not None for k in range(2)]))
            day += DAY
    df = filled_days(spark.createDataFrame(rows, READINGS), ["place"], "day", ["heat", "rain"], age, span)
    assert df.columns == ["place", "day", "heat", "rain", "heat_filled", "rain_filled"]
    assert tuples(df) == sorted(want, key=repr)
    assert filled_days(spark.createDataFrame([], READINGS), ["place"], "day", ["heat"], age).count() == 0
