"""Incremental jobs. Each drains the files that are there and ends; the result is read as a table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.catalog.base import Inputs, query
from siltline.catalog.derived import WEATHER_RAW
from siltline.catalog.models import READINGS, readings_columns
from siltline.plans.silver import weather_daily_readings
from siltline.sources import landing
from siltline.sources.schemas import RAW_COLUMNS, silver_table
from siltline.streaming import dedup_stream, first_rows, incremental, sums


@query("o1_incremental", READINGS)
def incremental_readings(t: Inputs):
    """Two landings, each followed by a run. The second touches partitions that the first has filled, and
    holds keys that are stored already."""
    root, target, checkpoint = t.folder("o1_raw"), t.folder("o1_table"), t.folder("o1_checkpoint")
    spec = silver_table("weather_daily_readings")
    names = RAW_COLUMNS[spec.name]
    raw = t.derive(WEATHER_RAW)
    middle = t.events.agg((F.max("event_id") / 2).alias("m")).scalar()
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    for part in (raw.where(F.col("event_id") <= middle), raw.where(F.col("event_id") > middle)):
        landing.write_csv(part.orderBy("event_id").select(*names), root, mode="append")
        incremental.run_available(
            t.spark, root, schema, lambda b: weather_daily_readings(b), target, spec.schema,
            ["date", "province"], spec.partition_by, checkpoint,
        )
    return readings_columns(t.spark.read.schema(spec.schema).parquet(target))


# Prices by month, customer and state; the second form halves the price of finished orders of 1996 and has no open ones there.
PRICES = """
select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, o_custkey, o_orderstatus,
  cast(o_totalprice as decimal(18,2)) as price, cast(1 as bigint) as orders from {orders}
"""
REVISED_PRICES = """
select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, o_custkey, o_orderstatus,
  cast(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) - 500.25 else cast(o_totalprice as decimal(18,2)) end as decimal(18,2)) as price,
  cast(1 as bigint) as orders from {orders} where year(o_orderdate) = 1996 and o_orderstatus <> 'O'
"""


@query(
    "o1_incremental_sums",
    f"""
    select year, o_custkey, o_orderstatus, cast(sum(price) as double) as price, cast(sum(orders) as bigint) as orders
    from (select * from ({PRICES}) as p where year <> 1996 union all select * from ({REVISED_PRICES}) as r) as x group by 1, 2, 3
    """,
)
def incremental_sums(t: Inputs):
    """Three batches: the years to 1997, the later ones (twice), and 1996 anew, where a third of the groups is gone."""
    rows = t.derive(PRICES)
    kept = sums.Sums(t.spark, t.folder("o1_prices"), t.folder("o1_sums"), rows.schema, ["year", "o_custkey", "o_orderstatus"], ["price", "orders"], ["year"])
    early, late = rows.where("year <= 1997"), rows.where("year > 1997")
    for batch_id, batch in ((1, early), (2, late), (2, late), (3, t.derive(REVISED_PRICES)), (2, late)):
        kept.replace(batch, batch_id)
    return kept.read().select("year", "o_custkey", "o_orderstatus", "price", F.col("orders").cast("bigint").alias("orders"))


@query(
    "o1_ingest_once_stream",
    "select event_type, count(*) as n, cast(sum(event_id) as bigint) as id_sum from {events} group by 1",
)
def ingest_once_stream(t: Inputs):
    """Rows of a file tree that is drained twice, the second time after nothing new came."""
    root, target, checkpoint = t.folder("o1_files"), t.folder("o1_rows"), t.folder("o1_files_checkpoint")
    rows = t.events.select("event_id", "event_type")
    rows.write.parquet(root)
    for _ in range(2):
        stream = t.spark.readStream.schema(rows.schema).parquet(root)
        dedup_stream.append_available(stream, target, checkpoint)
    stored = t.spark.read.schema(rows.schema).parquet(target)
    return stored.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))


@query("o2_stream_dedup", "select distinct user_id, event_type from {events}")
def stream_dedup(t: Inputs):
    target, checkpoint = t.folder("o2_rows"), t.folder("o2_checkpoint")
    stream = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.root)
    first = dedup_stream.first_seen(stream.select("ts", "user_id", "event_type"), ["user_id", "event_type"], "ts", "40 days")
    dedup_stream.append_available(first.select("user_id", "event_type"), target, checkpoint)
    return t.spark.read.schema(first.select("user_id", "event_type").schema).parquet(target)


# Readings as they are landed: the early ones, the later ones, and then some of the first days again under other numbers.
ARRIVALS = """
select 1 as turn, event_id, ts, event_type, value from {events} where event_id < (select count(*) from {events}) / 2
union all select 2 as turn, event_id, ts, event_type, value from {events} where event_id >= (select count(*) from {events}) / 2
union all select 3 as turn, -event_id as event_id, ts, event_type, value from {events} where cast(ts as date) in (date '2024-01-02', date '2024-01-28', date '2024-01-29')
"""
DELAY_DAYS = 4


@query(
    "o2_first_reading",
    f"""
    with a as ({ARRIVALS}), ends as (select max(ts) - interval {DELAY_DAYS} day as mark from {{events}}),
    judged as (select a.*, turn = 3 and cast(ts as date) + interval 1 day <= mark as late from a, ends),
    first as (select *, row_number() over (partition by cast(ts as date), event_type order by ts, event_id) as rn from judged where not late)
    select cast(event_id as bigint) as event_id, event_type, value, cast(null as string) as reason from first where rn = 1
    union all select cast(event_id as bigint) as event_id, event_type, value, 'came after its window was closed' as reason from judged where late
    """,
)
def first_reading(t: Inputs):
    """Three landings, each drained by a run of its own. The third brings a day that is closed and two that are not."""
    root, target, checkpoint = t.folder("o2_landed"), t.folder("o2_first"), t.folder("o2_first_checkpoint")
    arrivals = t.derive(ARRIVALS).withColumn("ts", F.col("ts").cast("string"))
    names = ["event_id", "ts", "event_type", "value"]
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    kept = first_rows.FirstRows(t.spark, target, schema, ["event_type"], "ts", ["ts", "event_id"], delay=timedelta(days=DELAY_DAYS))
    raw = T.StructType([T.StructField(c, T.StringType()) for c in names])
    for turn in (1, 2, 3):
        landing.write_csv(arrivals.where(F.col("turn") == turn).select(*names), root, mode="append")
        incremental.drain_files(t.spark, root, raw, lambda rows, batch_id: kept.take(
            rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]), batch_id), checkpoint)
    given = kept.rows(with_open=True).withColumn("reason", F.lit(None).cast("string"))
    return given.unionByName(kept.late()).select("event_id", "event_type", "value", "reason")
