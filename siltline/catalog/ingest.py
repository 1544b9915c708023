"""Sources, sinks and payloads."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.catalog.base import Inputs, query
from siltline.catalog.derived import INDICATOR_VALUES, RAW_ORDERS
from siltline.session import hadoop_path
from siltline.sources import landing, payload, raw_csv, tables

RAW_COLUMNS = ["order_id", "customer_id", "day_text", "amount_text", "label_text"]


@query("a1_read_raw_csv", RAW_ORDERS)
def read_raw_csv(t: Inputs):
    root = t.folder("a1")
    raw = t.derive(RAW_ORDERS)
    landing.write_csv(raw.withColumn("month", F.substring("day_text", 6, 2)), root, partition_by=["month"])
    return raw_csv.read_raw_csv(t.spark, root, RAW_COLUMNS)


BROKEN = """
select cast(o_orderkey as string) as order_id, concat(o_orderpriority, chr(10), '"', o_orderstatus, '", ', chr(10), chr(10), 'end') as note,
  case when o_orderstatus = 'F' then concat(chr(10), o_orderpriority) end as other
from {orders}
"""


@query("a1_quoted_breaks", BROKEN)
def quoted_breaks(t: Inputs):
    """Texts with line breaks and quotes come back whole."""
    root = t.folder("a1_breaks")
    landing.land(t.derive(BROKEN), root, "orders", date(2024, 1, 1), line_breaks=landing.QUOTE)
    return raw_csv.read_raw_csv(t.spark, root, ["order_id", "note", "other"], multi_line=True)


@query(
    "a2_bronze_landing",
    """
    select concat('source=orders/year=', cast(year(o_orderdate) as string),
                  '/month=', lpad(cast(month(o_orderdate) as string), 2, '0')) as folder,
           count(*) as n, cast(sum(o_orderkey) as bigint) as key_sum
    from {orders} group by 1
    """,
)
def bronze_landing(t: Inputs):
    root = t.folder("a2")
    orders = t.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    landing.land(orders, root, "orders", "day")
    back = landing.with_file_metadata(raw_csv.read_raw_csv(t.spark, root, t.orders.columns))
    folder = F.regexp_extract("source_file", "(source=[^/]+/year=[^/]+/month=[^/]+)/", 1)
    return back.groupBy(folder.alias("folder")).agg(
        F.count("*").alias("n"), F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum")
    )


@query(
    "a2_landing_key",
    """
    select o_orderkey, concat('source=orders/year=', cast(year(o_orderdate) as string), '/month=',
      lpad(cast(month(o_orderdate) as string), 2, '0'), '/', o_orderpriority, '.csv') as landing_key
    from {orders}
    """,
)
def landing_key(t: Inputs):
    name = F.concat("o_orderpriority", F.lit(".csv"))
    key = landing.landing_key("orders", F.col("o_orderdate"), name)
    return t.orders.select("o_orderkey", key.alias("landing_key"))


# One landing per order day. Days that held an urgent finished order were landed before; days without a
# pending order have nothing to land.
DAYS = """
with days as (
  select cast(cast(o_orderdate as date) as string) as day, count(case when o_orderstatus = 'P' then 1 end) as pending
  from {orders} group by 1),
ledger as (
  select distinct cast(cast(o_orderdate as date) as string) as day from {orders}
  where o_orderstatus = 'F' and o_orderpriority = '1-URGENT')
"""


def _days(t: Inputs):
    day = F.col("o_orderdate").cast("date").cast("string").alias("day")
    days = t.orders.groupBy(day).agg(F.count_if(F.col("o_orderstatus") == "P").alias("pending"))
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return days, t.orders.where(urgent).select(day)


@query(
    "a3_ingest_once",
    DAYS + "select day, pending from days where not exists (select 1 from ledger where ledger.day = days.day)",
)
def ingest_once(t: Inputs):
    days, ledger = _days(t)
    return landing.pending(days, ledger, "day")


@query(
    "a3_status_counts",
    DAYS
    + """select case when ledger.day is not null then 'skipped' when pending = 0 then 'skipped' else 'uploaded' end as status,
         count(*) as n from days left join ledger on days.day = ledger.day group by 1""",
)
def status_counts(t: Inputs):
    days, ledger = _days(t)
    return landing.status_counts(landing.with_status(days, ledger, "day", empty=F.col("pending") == 0))


@query(
    "a4_landing_metadata",
    """
    select p_partkey, p_type, '2024-03-01 06:00:00' as ingested_at, 'parts' as dataset_id,
           'http://example.com/parts.csv' as source_url, true as from_csv, true as has_bytes, true as has_time
    from {part}
    """,
)
def landing_metadata(t: Inputs):
    root = t.folder("a4")
    landing.write_csv(t.part.select("p_partkey", "p_type"), root)
    read = landing.with_file_metadata(raw_csv.read_raw_csv(t.spark, root, ["p_partkey", "p_type"]))
    facts = landing.with_landing_metadata(
        read, datetime(2024, 3, 1, 6), dataset_id="parts", source_url="http://example.com/parts.csv"
    )
    return facts.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_type", "ingested_at", "dataset_id", "source_url",
        F.col("source_file").endswith(".csv").alias("from_csv"),
        (F.col("source_bytes") > 0).alias("has_bytes"),
        F.col("source_modified_at").isNotNull().alias("has_time"),
    )


@query("a3_land_twice", "select 'uploaded,skipped,uploaded' as statuses, cast(2 * count(*) as bigint) as n, cast(2 * count(*) as bigint) as in_ledger from {part}")
def land_twice(t: Inputs):
    """The same key twice and another one: what is landed once is not landed again."""
    root, ledger = t.folder("a3_landed"), t.folder("a3_ledger")
    rows = t.part.select("p_partkey", "p_type")
    days = [date(2024, 3, 1), date(2024, 3, 9), date(2024, 4, 1)]
    statuses = [landing.land_once(rows, root, "parts", d, "parts.csv", ledger, datetime(2024, 3, 1, 6)) for d in days]
    landed = raw_csv.read_raw_csv(t.spark, root, ["p_partkey"]).agg(F.count("*").alias("n"))
    known = landing.read_ledger(t.spark, ledger).agg(F.sum("rows")).scalar()
    return landed.select(F.lit(",".join(statuses)).alias("statuses"), "n", known.alias("in_ledger"))


@query(
    "a4_metadata_from_ledger",
    """
    select p_partkey, p_type, '2024-03-01 06:00:00' as ingested_at, 'http://example.com/parts.csv' as source_url from {part}
    """,
)
def metadata_from_ledger(t: Inputs):
    """A later reader finds the facts of a landing by the key that its files lie under."""
    root, ledger = t.folder("a4_landed"), t.folder("a4_ledger")
    rows = t.part.select("p_partkey", "p_type")
    landing.land_once(rows, root, "parts", date(2024, 3, 1), "parts.csv", ledger, datetime(2024, 3, 1, 6), source_url="http://example.com/parts.csv")
    read = raw_csv.read_raw_csv(t.spark, root, ["p_partkey", "p_type"], position=True)
    key = F.regexp_extract(raw_csv.FILE, "(source=[^/]+/year=[^/]+/month=[^/]+/[^/]+)/", 1)
    facts = landing.read_ledger(t.spark, ledger).select("key", "ingested_at", F.col("details")["source_url"].alias("source_url"))
    return read.withColumn("key", key).join(facts, "key").select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_type", F.col("ingested_at").cast("string").alias("ingested_at"), "source_url")


@query(
    "a5_partition_overwrite",
    """
    select o_orderkey, case when year(o_orderdate) = 1997 then concat('late ', o_orderpriority) else o_orderpriority end as priority,
           cast(year(o_orderdate) as int) as year
    from {orders}
    """,
)
def partition_overwrite(t: Inputs):
    path = t.folder("a5")
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year"))
    tables.overwrite_partitions(rows, path, ["year"])
    revised = rows.where(F.col("year") == 1997).withColumn("priority", F.concat(F.lit("late "), "priority"))
    for _ in range(2):
        tables.overwrite_partitions(revised, path, ["year"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "a6_typed_table",
    """
    select o_orderkey, o_orderpriority, cast(cast(o_totalprice as decimal(18,4)) as double) as o_totalprice,
           cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month
    from {orders}
    """,
)
def typed_table(t: Inputs):
    location = t.folder("a6")
    name = "siltline_" + location.rsplit("-", 1)[1]
    schema = T.StructType.fromDDL(
        "o_orderkey bigint, o_orderpriority string, o_totalprice decimal(18,4), year int, month int"
    )
    for _ in range(2):
        tables.create_table(t.spark, name, schema, ["year", "month"], location)
    rows = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    tables.overwrite_table(tables.conform(rows, schema), name, ["year", "month"])
    return t.spark.table(name)


def indicator_payloads(t: Inputs):
    """One record payload per indicator and country; its array is bounded by the years. Countries of one
    priority send an object that is not a list of records."""
    record = F.struct(
        F.struct(F.col("country").alias("value")).alias("country"),
        F.col("country_code").alias("countryiso3code"),
        F.col("year").cast("string").alias("date"),
        F.col("amount").alias("value"),
    )
    per_key = t.derive(INDICATOR_VALUES).groupBy("indicator", "indicator_code", "country").agg(
        F.to_json(F.array_sort(F.collect_list(record))).alias("records")
    )
    body = F.when(F.col("indicator_code") == "5-LOW", F.lit('{"error":"bad"}')).otherwise(
        F.concat(F.lit('[{"page":1},'), "records", F.lit("]"))
    )
    return per_key.select("indicator", "indicator_code", body.alias("body"))


RECORD_ROWS = f"""
select country, country_code, indicator, indicator_code, cast(year as string) as year, cast(amount as double) as value
from ({INDICATOR_VALUES}) as v where indicator_code <> '5-LOW'
"""


@query("a7_flatten_records", RECORD_ROWS)
def flatten_records(t: Inputs):
    rows = payload.flatten_records(indicator_payloads(t), "body", "indicator", "indicator_code")
    return rows.withColumn("value", F.col("value").try_cast("double"))


@query(
    "a8_zip_columns",
    """
    select cast(cast(ts as date) as string) as date, user_id, min(value) as lowest, max(value) as highest,
           count(*) as n, cast(null as string) as wind
    from {events} group by 1, 2
    """,
)
def zip_columns(t: Inputs):
    day = F.col("ts").cast("date").cast("string")
    daily = t.events.groupBy("user_id", day.alias("day")).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")
    )
    series = daily.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("day", "lo", "hi", "n"))).alias("s"))
    block = F.struct(
        F.col("s.day").alias("time"), F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"), F.col("s.n").alias("n")
    )
    bodies = series.select("user_id", F.to_json(F.struct(block.alias("daily"))).alias("body"))
    fields = {"lo": "lowest", "hi": "highest", "n": "n", "wind_speed": "wind"}
    rows = payload.zip_columns(bodies, "body", fields, ["user_id"])
    return rows.withColumns({
        "lowest": F.col("lowest").try_cast("double"),
        "highest": F.col("highest").try_cast("double"),
        "n": F.col("n").try_cast("bigint"),
    })


@query(
    "a9_pick_resource",
    """
    select p_partkey,
      case when p_type = 'SMALL' then 'api_error' when p_type in ('PROMO', 'LARGE', 'MEDIUM') then 'ok' else 'no_resource' end as status,
      case when p_type = 'MEDIUM' then 'http://example.com/?v=2'
           when p_type in ('PROMO', 'LARGE') then concat('http://example.com/d/', replace(p_name, ' ', '_'), '.csv?v=', cast(p_size as string))
           end as url,
      case when p_type in ('PROMO', 'LARGE', 'MEDIUM') then p_name end as resource_name,
      case when p_type = 'MEDIUM' then 'example.com' when p_type in ('PROMO', 'LARGE') then concat(replace(p_name, ' ', '_'), '.csv') end as file_name
    from {part}
    """,
)
def pick_resource(t: Inputs):
    url = F.when(F.col("p_type") == "MEDIUM", F.lit("http://example.com/?v=2")).otherwise(
        F.concat(F.lit("http://example.com/d/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".csv?v="), F.col("p_size").cast("string"))
    )
    kind = F.when(F.col("p_type").isin("PROMO", "LARGE", "MEDIUM"), "csv").otherwise("xls")
    resource = lambda f, u: F.struct(f.alias("format"), u.alias("url"), F.col("p_name").alias("name"))
    resources = F.array(resource(F.lit("PDF"), F.lit("http://example.com/a.pdf")), resource(kind, url), resource(kind, F.lit("http://example.com/z.csv")))
    body = F.struct((F.col("p_type") != "SMALL").alias("success"), F.struct(resources.alias("resources")).alias("result"))
    return payload.pick_resource(t.part.select("p_partkey", F.to_json(body).alias("body")), "body", "parts.csv")


@query(
    "a10_concat_sorted",
    """
    select 'spend' as indicator, cast(year(o_orderdate) as int) as year, o_custkey as id, count(*) as n from {orders} group by 2, 3
    union all
    select 'usage' as indicator, cast(year(ts) as int) as year, user_id as id, count(*) as n from {events} group by 2, 3
    """,
)
def concat_sorted(t: Inputs):
    spend = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    usage = t.events.groupBy(F.year("ts").alias("year"), F.col("user_id").alias("id")).agg(F.count("*").alias("n"))
    none = usage.where(F.col("year").isNull())
    named = [f.select(F.lit(name).alias("indicator"), "year", "id", "n") for name, f in (("spend", spend), ("usage", usage), ("none", none))]
    return payload.concat_sorted(named, ["indicator", "year"])


REORDERED = [["p_partkey", "p_type", "p_size"], ["p_size", "p_partkey", "p_type"], ["p_type", "p_size", "p_partkey"]]


def _reordered(t: Inputs, label: str) -> str:
    """Parts in three files of one tree: other column orders, an upper-case name, none at all, one in a deeper folder."""
    root = t.folder(label)
    for k, columns in enumerate(REORDERED):
        staged = t.folder(f"{label}_{k}")
        landing.write_csv(t.part.where(F.col("p_partkey") % 3 == k).select(*columns).coalesce(1), staged)
        fs, folder = hadoop_path(t.spark, staged)
        written = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
        _, goal = hadoop_path(t.spark, f"{root}/{['F.CSV', 'download', 'deeper/G.csv'][k]}")
        fs.mkdirs(goal.getParent())
        fs.rename(written, goal)
    return root


@query("a1_reordered_header", "select cast(p_size as string) as p_size, p_type, cast(p_partkey as string) as p_partkey from {part}")
def reordered_header(t: Inputs):
    return raw_csv.read_raw_csv(t.spark, _reordered(t, "a1_reordered"), ["p_size", "p_type", "p_partkey"])


@query("a11_mixed_folder", "select cast(p_size as string) as p_size, p_type, cast(p_partkey as string) as p_partkey from {part}")
def mixed_folder(t: Inputs):
    """Files of different headers in one folder and in a folder below it; no file comes twice or goes by its name."""
    return raw_csv.read_drifting_csv(t.spark, _reordered(t, "a11_mixed"))


@query(
    "a11_drifting_headers",
    """
    select cast(o_orderkey as string) as o_orderkey, o_orderstatus, case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority,
           case when o_orderstatus = 'P' then cast(o_custkey as string) end as o_custkey
    from {orders}
    """,
)
def drifting_headers(t: Inputs):
    root = t.folder("a11")
    landings = {
        "F": ["o_orderkey", "o_orderstatus"],
        "O": ["o_orderstatus", "o_orderpriority", "o_orderkey"],
        "P": ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"],
    }
    for status, columns in landings.items():
        landing.write_csv(t.orders.where(F.col("o_orderstatus") == status).select(*columns), f"{root}/landing={status}")
    return raw_csv.read_drifting_csv(t.spark, root)
