"""First rows of a stream against a batch, with a run that breaks off and late rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from siltline.session import workspace
from siltline.sources import landing
from siltline.streaming import first_rows
from siltline.streaming.first_rows import LATE, FirstRows
from siltline.streaming.incremental import drain_files

T0 = datetime(2024, 1, 1)
SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("place", T.StringType()), T.StructField("heat", T.StringType())])


def batches(seed):
    """Times go forward by and large; a third of the rows has one key; repeats, ties, nulls and rows far behind."""
    r, out, n = random.Random(seed), [], 0
    for b in range(5):
        rows = []
        for _ in range(60):
            at = T0 + timedelta(days=3 * b) + timedelta(hours=r.choice((r.randrange(0, 72), r.randrange(0, 6), -r.randrange(0, 200))))
            rows.append((n, r.choice((at, at, at, None)) if n % 11 == 0 else at, "hot" if n % 3 == 0 else r.choice(["a", "b", None]), r.choice(["x", "y"])))
            n += 1
        out.append(rows + rows[:2])
    return out


def expected(given, delay):
    """What a batch gives: rows in the order they come, judged by the watermark of the batches before."""
    mark, best, late = datetime.min, {}, []
    for rows in given:
        top = mark
        for row in rows:
            _, at, place, _ = row
            if at is None or place is None:
                late.append((*row, "no key or time"))
            else:
                top = max(top, at - delay)
                day = datetime(at.year, at.month, at.day)
                if day + timedelta(days=1) <= mark:
                    late.append((*row, LATE))
                else:
                    best[day, place] = min(best.get((day, place), (at, row[0], row)), (at, row[0], row))
            if at is not None:
                top = max(top, at - delay)
        mark = top
    closed = [v[2] for (day, _), v in best.items() if day + timedelta(days=1) <= mark]
    return sorted(closed), sorted(v[2] for v in best.values()), sorted(late, key=repr)


@pytest.mark.parametrize("days", [1, 4])
def test_equal_to_a_batch(spark, days):
    given, delay = batches(days), timedelta(days=days)
    kept = FirstRows(spark, workspace(spark, "test-first"), SCHEMA, ["place"], "at", ["at", "n"], delay=delay)
    assert kept.rows(True).count() == 0 and kept.late().count() == 0
    for i, rows in enumerate(given):
        kept.take(spark.createDataFrame(rows, SCHEMA), i)
    closed, every, late = expected(given, delay)
    assert sorted(map(tuple, kept.rows().collect())) == closed and 0 < len(closed) < len(every)
    assert sorted(map(tuple, kept.rows(with_open=True).collect())) == every
    assert sorted(map(tuple, kept.late().collect()), key=repr) == late and any(x[-1] == LATE for x in late)


@pytest.mark.parametrize("lost", ["rows", "open", "marks"])
def test_a_batch_that_broke_off_is_run_again(spark, monkeypatch, lost):
    given, delay = batches(7), timedelta(days=1)
    kept = FirstRows(spark, workspace(spark, "test-first"), SCHEMA, ["place"], "at", ["at", "n"], delay=delay)
    for i, rows in enumerate(given):
        if i == 2:
            real = kept._path
            monkeypatch.setattr(kept, "_path", lambda kind, b: real(kind, b) if (kind, b) != (lost, 2) else "no-such-scheme://x")
            with pytest.raises(Exception):  # noqa: B017
                kept.take(spark.createDataFrame(rows, SCHEMA), i)
            monkeypatch.setattr(kept, "_path", real)
        kept.take(spark.createDataFrame(rows, SCHEMA), i)
    kept.take(spark.createDataFrame(given[-1], SCHEMA), len(given) - 1)  # the last one once more
    closed, every, late = expected(given, delay)
    assert sorted(map(tuple, kept.rows().collect())) == closed and sorted(map(tuple, kept.rows(True).collect())) == every
    assert sorted(map(tuple, kept.late().collect()), key=repr) == late


def test_restart_between_two_drains(spark):
    root, target, checkpoint = (workspace(spark, f"test-{x}") for x in ("landed", "first", "checkpoint"))
    given, delay = batches(3), timedelta(days=2)
    raw = T.StructType([T.StructField(c, T.StringType()) for c in SCHEMA.names])
    for rows in given:
        kept = FirstRows(spark, target, SCHEMA, ["place"], "at", ["at", "n"], delay=delay)  # a process of its own
        df = spark.createDataFrame(rows, SCHEMA)
        landing.write_csv(df.select(*[df[c].cast("string").alias(c) for c in SCHEMA.names]), root, mode="append")
        for _ in range(2):  # the second drain finds nothing new
            drain_files(spark, root, raw, lambda x, i: kept.take(x.select(*[x[f.name].try_cast(f.dataType).alias(f.name) for f in SCHEMA.fields]), i), checkpoint)  # noqa: B023
    closed, every, late = expected(given, delay)
    assert sorted(map(tuple, kept.rows().collect())) == closed and sorted(map(tuple, kept.rows(True).collect())) == every
    assert sorted(map(tuple, kept.late().collect()), key=repr) == late
    plan = kept.rows()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and first_rows.LATE == LATE
