from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

from siltline.plans.silver import weather_daily_readings
from siltline.sources import landing
from siltline.sources.schemas import RAW_COLUMNS, silver_table
from siltline.streaming import dedup_stream, incremental
from tests.conftest import tuples

SPEC = silver_table("weather_daily_readings")
RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[SPEC.name]])


def readings(frame, *rows):
    return frame(", ".join(f"{c} string" for c in RAW.names), *[(d, p, "1", "2", v, "4", "5", "6", "7") for d, p, v in rows])


def run(spark, root, target, checkpoint, **options):
    incremental.run_available(spark, root, RAW, weather_daily_readings, target, SPEC.schema, ["date", "province"], SPEC.partition_by, checkpoint, timeout=120, **options)
    return tuples(spark.read.schema(SPEC.schema).parquet(target), "date", "province", "temp_max_c")


def test_new_files_join_stored_partitions(spark, frame, tmp_path):
    root, target, checkpoint = (str(tmp_path / n) for n in ("raw", "silver", "checkpoint"))
    landing.write_csv(readings(frame, ("2024-01-01", "a", "1"), ("2024-01-02", "a", "2")), root, "append")
    first = run(spark, root, target, checkpoint)
    assert first == [(date(2024, 1, 1), "a", Decimal("1")), (date(2024, 1, 2), "a", Decimal("2"))]
    assert run(spark, root, target, checkpoint) == first
    landing.write_csv(readings(frame, ("2024-01-01", "a", "99"), ("2024-01-01", "b", "3"), ("2024-02-01", "a", "4")), root, "append")
    assert run(spark, root, target, checkpoint) == [
        (date(2024, 1, 1), "a", Decimal("1")), (date(2024, 1, 1), "b", Decimal("3")),
        (date(2024, 1, 2), "a", Decimal("2")), (date(2024, 2, 1), "a", Decimal("4"))]


def test_one_file_at_a_time_gives_the_same(spark, frame, tmp_path):
    root, target, checkpoint = (str(tmp_path / n) for n in ("raw", "silver", "checkpoint"))
    for day in range(1, 4):
        landing.write_csv(readings(frame, (f"2024-01-0{day}", "a", str(day)), ("2024-01-09", "a", str(day))).coalesce(1), root, "append")
    rows = run(spark, root, target, checkpoint, max_files_per_batch=1)
    assert [r[0].day for r in rows] == [1, 2, 3, 9]


def test_repeated_batch_changes_nothing(spark, frame, tmp_path):
    target, staging = str(tmp_path / "silver"), str(tmp_path / "staging")
    batch = frame("k int, v string, year int", (1, "a", 2024), (2, "b", 2024), (3, "c", 2025))
    schema = batch.schema
    for _ in range(2):
        incremental.upsert_first(spark, batch, target, staging, schema, ["k"], ["year"])
    incremental.upsert_first(spark, frame("k int, v string, year int", (2, "late", 2024), (4, "d", 2024)), target, staging, schema, ["k"], ["year"])
    assert tuples(spark.read.schema(schema).parquet(target)) == [(1, "a", 2024), (2, "b", 2024), (3, "c", 2025), (4, "d", 2024)]


def test_only_touched_partitions_are_read(spark, frame, tmp_path):
    target = str(tmp_path / "t")
    rows = frame("k int, year int", (1, 2023), (2, 2024), (3, 2025))
    rows.write.partitionBy("year").parquet(target)
    merged = incremental.merge_first(spark.read.schema(rows.schema).parquet(target), frame("k int, year int", (9, 2024)), ["k"], ["year"])
    assert tuples(merged) == [(2, 2024), (9, 2024)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws" in plan or "PartitionFilters: [cast(year" in plan


def test_a_key_stored_under_another_partition_is_known(spark, frame, tmp_path):
    target, staging = str(tmp_path / "silver"), str(tmp_path / "staging")
    for rows in ([(1, 2024)], [(1, 2025), (2, 2025)]):
        batch = frame("k int, year int", *rows)
        incremental.upsert_first(spark, batch, target, staging, batch.schema, ["k"], ["year"])
    assert tuples(spark.read.schema("k int, year int").parquet(target)) == [(1, 2024), (2, 2025)]
    assert not (tmp_path / "staging").exists()


def test_a_stream_binds_columns_by_header(spark, frame, tmp_path):
    root, target, checkpoint = (str(tmp_path / n) for n in ("raw", "silver", "checkpoint"))
    rows = readings(frame, ("2024-01-01", "a", "1"))
    landing.write_csv(rows.select(*reversed(rows.columns)), root)
    assert run(spark, root, target, checkpoint) == [(date(2024, 1, 1), "a", Decimal("1"))]


def test_stream_dedup(spark, frame, tmp_path):
    root, target, checkpoint = (str(tmp_path / n) for n in ("events", "out", "checkpoint"))
    rows = spark.range(300).selectExpr("id % 50 as k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts")
    rows.write.parquet(root)
    stream = spark.readStream.schema(rows.schema).parquet(root)
    dedup_stream.append_available(dedup_stream.first_seen(stream, ["k"], "ts", "1 hour").select("k"), target, checkpoint, 120)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == list(range(50))
