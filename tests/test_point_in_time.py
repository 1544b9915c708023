"""Point-in-time join against a brute-force range join."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltline.operators import scd
from siltline.operators.point_in_time import at_own_time
from tests.conftest import plan_of, tuples

T0 = datetime(2024, 1, 1)
FACTS = "id string, at timestamp, n int, `a.b` string, segment string"
HISTORY = "key string, segment string, place string, valid_from timestamp, valid_to timestamp, updated_at timestamp"


def some(seed, rows, hot):
    """A third of the facts and many versions on one key; facts on the edges of intervals, before and after all, without key or time."""
    r = random.Random(seed)
    moment = lambda: T0 + timedelta(hours=r.randrange(-200, 3000))
    keys = ["hot", *(f"k{i}" for i in range(12))]
    history = []
    for key in keys:
        edges = sorted({moment() for _ in range(40 if key == "hot" else r.randrange(0, 5))})
        for i, start in enumerate(edges):
            end = edges[i + 1] if i + 1 < len(edges) else r.choice((None, start + timedelta(hours=50)))
            if r.random() < 0.9:  # a gap now and then
                history.append((key, r.choice(("x", "y", None)), f"p{i}", start, end, start))
    edges = [h[3] for h in history] + [h[4] for h in history if h[4]]
    facts = [("hot" if i < hot else r.choice([*keys, "unknown", None]), r.choice((moment(), r.choice(edges), None if i % 9 == 0 else moment())), i, "c", "own") for i in range(rows)]
    return facts + facts[:5], history


def brute(facts, history):
    out = []
    for f in facts:
        hit = [h for h in history if f[0] is not None and f[1] is not None and h[0] == f[0] and h[3] <= f[1] and (h[4] is None or f[1] < h[4])]
        assert len(hit) <= 1
        out.append((*f, *(hit[0][1:3] if hit else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("days", "rows"), [(30, 1_000_000), (1, 1_000_000), (7, 10), (100_000, 25)])
def test_equal_to_a_range_join(spark, days, rows):
    facts, history = some(days, 400, 140)
    df = at_own_time(spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY), "id", "at", "key",
                     {"segment": "old_segment", "place": "place"}, range_days=days, range_rows=rows)
    assert df.columns == ["id", "at", "n", "a.b", "segment", "old_segment", "place"]
    assert tuples(df) == brute(facts, history)


def test_history_of_a_snapshot(spark):
    """Runs of a snapshot give intervals that touch; a fact at the moment of a run meets the new row."""
    runs = [datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)]
    versions = [[("a", 1), ("b", 1)], [("a", 2), ("b", 1)], [("a", 3), ("c", 1)]]
    frames = [spark.createDataFrame(v, "k string, v int") for v in versions]
    history = scd.initial(frames[0], "k", ["v"], runs[0])
    for f, run in zip(frames[1:], runs[1:], strict=True):
        history = scd.snapshot(history, f, "k", ["v"], run)
    facts = spark.createDataFrame([(k, t) for k in "abc" for t in [datetime(2023, 12, 31), *runs, datetime(2025, 1, 1)]], "k string, t timestamp")
    got = {(r.k, r.t): r.seen for r in at_own_time(facts, history, "k", "t", "k", {"v": "seen"}).collect()}
    assert [got["a", t] for t in [datetime(2023, 12, 31), *runs, datetime(2025, 1, 1)]] == [None, 1, 2, 3, 3]
    assert [got["b", t] for t in runs] == [1, 1, 1] and got["c", runs[1]] is None and got["c", runs[2]] == 1


def test_empty_sides(spark):
    facts, history = some(1, 30, 10)
    no_facts, no_history = spark.createDataFrame([], FACTS), spark.createDataFrame([], HISTORY)
    known = spark.createDataFrame(history, HISTORY)
    assert at_own_time(no_facts, known, "id", "at", "key", {"place": "p"}).count() == 0
    rows = at_own_time(spark.createDataFrame(facts, FACTS), no_history, "id", "at", "key", {"place": "p"}).collect()
    assert len(rows) == len(facts) and {r.p for r in rows} == {None}


def test_a_hot_key_is_spread_and_nothing_is_compared_pairwise(spark):
    """One key with a third of all rows, all at one moment: its rows end in many parts."""
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(T0)).otherwise(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600)).alias("t"), F.col("id").alias("n"))
    history = spark.createDataFrame([("hot", "v", T0, None, T0)], "k string, v string, valid_from timestamp, valid_to timestamp, updated_at timestamp")
    df = at_own_time(facts, history, "k", "t", "k", {"v": "v"}, range_rows=500)
    assert df.where("k = 'hot' and v = 'v'").count() == 10_000 and df.count() == 30_000
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan and "Window" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        spread = at_own_time(facts, history, "k", "t", "k", {"v": "v"}, range_rows=500)
        tasks = [r["count"] for r in spread.where("k = 'hot' and v = 'v'").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) >= 8 and max(tasks) < 5000
