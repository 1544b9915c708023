"""Incremental sums against the sum over the whole table."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from siltline.session import workspace
from siltline.sources.tables import overwrite_partitions
from siltline.streaming import sums
from siltline.streaming.sums import Sums

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("amount", T.DecimalType(10, 2)),
    T.StructField("pieces", T.IntegerType()), T.StructField("year", T.IntegerType()),
])


@pytest.fixture
def kept(spark):
    root = workspace(spark, "test-sums")
    return Sums(spark, f"{root}/table", f"{root}/sums", SCHEMA, ["year", "kind"], ["amount", "pieces"], ["year"])


def rows(*lines):
    return [(i, kind, None if amount is None else Decimal(amount), pieces, year) for i, kind, amount, pieces, year in lines]


def expected(lines):
    out = {}
    for _, kind, amount, pieces, year in lines:
        a, p, n = out.get((year, kind), (Decimal(0), 0, 0))
        out[year, kind] = (a + (amount or 0), p + (pieces or 0), n + 1)
    return sorted([(*k, *v) for k, v in out.items()], key=repr)


def now(kept):
    return sorted([(r.year, r.kind, r.amount, int(r.pieces), r.rows_in) for r in kept.read().collect()], key=repr)


FIRST = rows((1, "a", "1.10", 1, 2020), (2, "a", "2.20", None, 2020), (3, None, "5.00", 2, 2020), (4, "b", None, 3, 2021), (4, "b", None, 3, 2021))
SECOND = rows((5, "a", "7.00", 1, 2022), (6, "c", "0.01", 9, 2022))
REVISED = rows((1, "a", "-3.00", 1, 2020), (7, "d", "4.00", 4, 2020))


def test_batches_repeats_and_a_revision(spark, kept):
    frame = lambda lines: spark.createDataFrame(lines, SCHEMA)
    assert now(kept) == []
    kept.replace(frame(FIRST), 1)
    assert now(kept) == expected(FIRST)
    for _ in range(2):
        kept.replace(frame(SECOND), 2)
        assert now(kept) == expected(FIRST + SECOND)
    kept.replace(frame(REVISED), 3)
    after = [x for x in FIRST if x[4] != 2020] + SECOND + REVISED
    assert now(kept) == expected(after)
    kept.replace(frame(FIRST), 1)  # an old batch again: what was replaced since stays
    assert now(kept) == expected(after)
    assert Counter(map(tuple, spark.read.schema(SCHEMA).parquet(kept.table).select(*SCHEMA.names).collect())) == Counter(after)
    kept.replace(frame([]), 4)
    assert now(kept) == expected(after)


@pytest.mark.parametrize("lost_after", ["change", "table", "staged", "one partition"])
def test_a_lost_batch_goes_on_where_it_was(spark, kept, monkeypatch, lost_after):
    frame = lambda lines: spark.createDataFrame(lines, SCHEMA)
    kept.replace(frame(FIRST), 1)
    batch = REVISED + rows((8, "b", "1.00", 1, 2021))
    real = overwrite_partitions
    calls = []

    def lost(df, path, partition_by):
        calls.append(path)
        if lost_after == "change" or (lost_after == "staged" and len(calls) == 2):
            raise RuntimeError("lost")
        real(df.where("year = 2020") if lost_after == "one partition" and len(calls) == 2 else df, path, partition_by)
        if lost_after == "table" or len(calls) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(sums, "overwrite_partitions", lost)
    with pytest.raises(RuntimeError):
        kept.replace(frame(batch), 2)
    monkeypatch.setattr(sums, "overwrite_partitions", real)
    kept.replace(frame(batch), 2)
    assert now(kept) == expected(batch)


def test_partition_columns_are_keys(spark):
    with pytest.raises(ValueError, match="year"):
        Sums(spark, "t", "s", SCHEMA, ["kind"], ["amount"], ["year"])
