"""Slowly changing dimension, date spine and request windows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from siltline.catalog.base import Inputs, query
from siltline.operators import fill, intervals, scd, star
from siltline.operators.point_in_time import at_own_time
from siltline.session import settle
from siltline.sources import history as store
from siltline.sources import landing, payload

# The same customers at three moments. At the second, those in debt changed their segment, one region's
# customers are not delivered, and the suppliers are new; at the third, the debtors are back.
FIRST = """
select c_custkey as id, c_mktsegment as segment, n_name as nation
from {customer} join {nation} on c_nationkey = n_nationkey
"""
SECOND = """
select c_custkey as id, case when c_acctbal < 0 then null else c_mktsegment end as segment, n_name as nation
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
where r_name <> 'ASIA'
union all
select s_suppkey + 1000000000 as id, 'SUPPLIER' as segment, n_name as nation
from {supplier} join {nation} on s_nationkey = n_nationkey
union all
select s_suppkey + 1000000000 as id, 'TRADER' as segment, n_name as nation
from {supplier} join {nation} on s_nationkey = n_nationkey
"""
RUNS = [datetime(2024, 1, 1), datetime(2024, 2, 1, 12), datetime(2024, 3, 1)]

HISTORY = f"""
with first_run as ({FIRST}), second_all as ({SECOND}),
second_run as (select id, min(segment) as segment, any_value(nation) as nation from second_all group by id),
after_second as (
  select f.id, f.segment, f.nation, '2024-01-01 00:00:00' as valid_from,
    case when s.id is not null and s.segment is distinct from f.segment then '2024-02-01 12:00:00' end as valid_to,
    case when s.id is not null and s.segment is distinct from f.segment then '2024-02-01 12:00:00' else '2024-01-01 00:00:00' end as updated_at
  from first_run f left join second_run s on f.id = s.id
  union all
  select s.id, s.segment, s.nation, '2024-02-01 12:00:00' as valid_from, cast(null as string) as valid_to, '2024-02-01 12:00:00' as updated_at
  from second_run s left join first_run f on f.id = s.id where f.id is null or s.segment is distinct from f.segment),
history as (
  select a.id, a.segment, a.nation, a.valid_from,
    case when a.valid_to is null and f.id is not null and f.segment is distinct from a.segment then '2024-03-01 00:00:00' else a.valid_to end as valid_to,
    case when a.valid_to is null and f.id is not null and f.segment is distinct from a.segment then '2024-03-01 00:00:00' else a.updated_at end as updated_at
  from after_second a left join first_run f on a.id = f.id
  union all
  select f.id, f.segment, f.nation, '2024-03-01 00:00:00' as valid_from, cast(null as string) as valid_to, '2024-03-01 00:00:00' as updated_at
  from first_run f join after_second a on a.id = f.id and a.valid_to is null where f.segment is distinct from a.segment)
"""


def customer_history(t: Inputs, runs: list[datetime] = RUNS):
    """Three runs. Each is written before the next reads it, as separate jobs would."""
    checked = ["segment", "nation"]
    first, second = t.derive(FIRST), t.derive(SECOND)
    history = settle(scd.initial(first, "id", checked, runs[0]), "i1")
    history = settle(scd.snapshot(history, second, "id", checked, runs[1]), "i1")
    return scd.snapshot(history, first, "id", checked, runs[2])


@query("i1_snapshot", HISTORY + "select id, segment, nation, valid_from, valid_to, updated_at from history")
def snapshot(t: Inputs):
    return customer_history(t)


@query("i1_history_store", HISTORY + "select id, segment, nation, valid_from, valid_to, updated_at from history")
def history_store(t: Inputs):
    """The same three runs against stored history, the last of them twice."""
    root, checked = t.folder("i1_store"), ["segment", "nation"]
    deliveries = [t.derive(FIRST), t.derive(SECOND), t.derive(FIRST)]
    for rows, run_ts in [*zip(deliveries, RUNS), (deliveries[2], RUNS[2])]:
        store.advance(t.spark, root, rows, "id", checked, run_ts)
    return store.read_history(t.spark, root)


@query("i1_corrected_rerun", f"""with rows as ({FIRST})
    select id, segment, nation, '2024-01-01 00:00:00' as valid_from, cast(null as string) as valid_to, '2024-01-01 00:00:00' as updated_at from rows""")
def corrected_rerun(t: Inputs):
    """The second run is repeated with the input of the first, which changes nothing; a late run is refused."""
    root, checked = t.folder("i1_corrected"), ["segment", "nation"]
    for rows, run_ts in ((FIRST, RUNS[0]), (SECOND, RUNS[1]), (FIRST, RUNS[1])):
        store.advance(t.spark, root, t.derive(rows), "id", checked, run_ts)
    try:
        store.advance(t.spark, root, t.derive(SECOND), "id", checked, RUNS[0])
    except ValueError:
        return store.read_history(t.spark, root)
    raise AssertionError("a run older than the last one was taken")


@query("i2_current_from_store", HISTORY + "select id, segment, nation, valid_from from history where valid_to is null")
def current_from_store(t: Inputs):
    root = t.folder("i2_store")
    for rows, run_ts in zip([FIRST, SECOND, FIRST], RUNS):
        store.advance(t.spark, root, t.derive(rows), "id", ["segment", "nation"], run_ts)
    return store.read_current(t.spark, root).select("id", "segment", "nation", "valid_from")


@query(
    "i1_snapshot_rerun",
    f"""with rows as ({FIRST})
    select id, segment, nation, '2024-01-01 00:00:00' as valid_from, cast(null as string) as valid_to, '2024-01-01 00:00:00' as updated_at from rows""",
)
def snapshot_rerun(t: Inputs):
    """A run on unchanged input changes nothing."""
    checked, rows = ["segment", "nation"], t.derive(FIRST)
    history = settle(scd.initial(rows, "id", checked, RUNS[0]), "i1_rerun")
    return scd.snapshot(history, rows, "id", checked, RUNS[1])


@query("i2_current_rows", HISTORY + "select id, segment, nation, valid_from from history where valid_to is null")
def current_rows(t: Inputs):
    return scd.current_rows(customer_history(t), "id").select("id", "segment", "nation", "valid_from")


@query(
    "i3_as_of",
    HISTORY + """select id, segment, nation from history
    where valid_from <= '2024-02-15 00:00:00' and (valid_to is null or '2024-02-15 00:00:00' < valid_to)""",
)
def as_of(t: Inputs):
    return scd.as_of(customer_history(t), datetime(2024, 2, 15)).select("id", "segment", "nation")


#: Runs that fall among the orders; the first orders come before all history.
ORDER_RUNS = [datetime(1995, 9, 1), datetime(1998, 2, 1, 12), datetime(2000, 3, 1)]


def _at_order_runs(text: str) -> str:
    for old, new in zip(RUNS, ORDER_RUNS, strict=True):
        text = text.replace(old.isoformat(" "), new.isoformat(" "))
    return text


@query(
    "i3_fact_as_of",
    _at_order_runs(HISTORY) + """select o_orderkey, o_custkey, cast(o_orderdate as string) as o_orderdate, segment, h.nation as nation
    from {orders} left join history h on h.id = o_custkey and cast(valid_from as timestamp) <= o_orderdate
      and (valid_to is null or o_orderdate < cast(valid_to as timestamp))""",
)
def fact_as_of(t: Inputs):
    """Each order with the customer as known on the day of the order."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return at_own_time(orders, customer_history(t, ORDER_RUNS), "o_custkey", "o_orderdate", "id", {"segment": "segment", "nation": "nation"})


@query(
    "j1_date_spine",
    """
    with ends as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from {orders}),
    spine as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d from ends),
    sold as (select cast(o_orderdate as date) as d, count(*) as n from {orders} group by 1)
    select cast(spine.d as string) as day, coalesce(n, 0) as n from spine left join sold on spine.d = sold.d
    """,
)
def date_spine(t: Inputs):
    """Orders per day, days without an order included."""
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day"))
    sold = days.groupBy("day").agg(F.count("*").alias("n"))
    spine = star.spine_of(days, "day", "day")
    return spine.join(sold, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "j2_date_dimension",
    """
    with spine as (select cast(d as date) as d from range(date '1993-01-01', date '2031-01-01', interval 1 day) as r(d)),
    sold as (select cast(o_orderdate as date) as d, count(*) as n from {orders} group by 1)
    select cast(spine.d as string) as date_key, cast(year(spine.d) as int) as year, cast(quarter(spine.d) as int) as quarter, cast(month(spine.d) as int) as month,
      cast(week(spine.d) as int) as week, concat(cast(year(spine.d) as string), '-Q', cast(quarter(spine.d) as string)) as year_quarter, coalesce(n, 0) as n
    from spine left join sold on spine.d = sold.d
    """,
)
def date_dimension(t: Inputs):
    dimension = star.date_dimension(star.date_spine(t.spark, date(1993, 1, 1), date(2031, 1, 1)))
    sold = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date_key")).agg(F.count("*").alias("n"))
    return dimension.join(sold, "date_key", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query(
    "j3_rolling_requests",
    """
    with last_day as (select o_custkey, cast(max(o_orderdate) as date) as end_date from {orders} group by 1)
    select o_custkey, cast(cast(end_date - interval 12 month as date) as string) as start_date, cast(end_date as string) as end_date
    from last_day where not exists (select 1 from {events} where user_id = o_custkey)
    """,
)
def rolling_requests(t: Inputs):
    """One request per customer for the year before the last order, unless the ledger holds it already."""
    stations = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("last_day"))
    requests = payload.rolling_requests(stations, F.col("last_day"))
    ledger = t.events.select(F.col("user_id").alias("o_custkey"))
    return landing.pending(requests, ledger, "o_custkey").select("o_custkey", "start_date", "end_date")


# Landed ranges of a customer: each order brings some days, some ranges are void.
LANDED = """
select o_custkey, cast(o_orderdate as date) as first_day,
  case when o_orderstatus = 'F' then cast(cast(o_orderdate as date) + interval '40' day as date) when o_orderstatus = 'O' then cast(o_orderdate as date)
       when o_orderpriority = '1-URGENT' then cast(cast(o_orderdate as date) - interval '1' day as date)
       when o_orderpriority = '2-HIGH' then null else cast(cast(o_orderdate as date) + interval '200' day as date) end as last_day
from {orders}
"""
WINDOW = (date(1996, 3, 1), date(2000, 2, 29))


@query(
    "j3_missing_windows",
    f"""
    with days as (select c_custkey as id, cast(d as date) as day from {{customer}}, range(date '{WINDOW[0]}', date '{WINDOW[1]}' + interval 1 day, interval 1 day) as r(d)),
    had as (select distinct o_custkey as id, cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as day
      from ({LANDED}) as l where last_day is not null and last_day >= first_day),
    missed as (select id, day, day - cast(row_number() over (partition by id order by day) as int) as island from days where not exists (select 1 from had where had.id = days.id and had.day = days.day))
    select id, cast(min(day) as string) as first_day, cast(max(day) as string) as last_day from missed group by id, island
    """,
)
def missing_windows(t: Inputs):
    """What is still to be requested of each customer in four years."""
    landed = t.derive(LANDED).withColumnRenamed("o_custkey", "id")
    wanted = t.customer.select(F.col("c_custkey").alias("id"))
    return intervals.missing_ranges(wanted, landed, ["id"], "first_day", "last_day", *WINDOW)


# The dearest order of a day by nation and segment, with days on which one of the two values is unknown.
DEAREST = """
select n_name as nation, c_mktsegment as segment, cast(o_orderdate as date) as day,
  max(case when o_orderstatus <> 'P' then cast(o_totalprice as decimal(18,2)) end) as price,
  max(case when o_orderpriority < '3' then o_orderpriority end) as priority
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey group by 1, 2, 3
"""
AGE = 9


def _filled(value: str) -> str:
    standing = f"last_value(case when {value} is not null then day end ignore nulls) over w"
    return f"case when s.day - {standing} <= {AGE} then last_value({value} ignore nulls) over w end"


@query(
    "j1_filled_readings",
    f"""
    with r as ({DEAREST}),
    spine as (select nation, segment, cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as d from r group by 1, 2),
    s as (select spine.nation, spine.segment, d as day, r.day as had, price, priority from spine left join r on r.nation = spine.nation and r.segment = spine.segment and r.day = d),
    f as (select nation, segment, day, price as p, priority as q, {_filled("price").replace("s.day", "day")} as price, {_filled("priority").replace("s.day", "day")} as priority
      from s window w as (partition by nation, segment order by day rows between unbounded preceding and current row))
    select nation, segment, cast(day as string) as day, cast(price as double) as price, priority, p is null and price is not null as price_filled,
      q is null and priority is not null as priority_filled from f
    """,
)
def filled_readings(t: Inputs):
    return fill.filled_days(t.derive(DEAREST), ["nation", "segment"], "day", ["price", "priority"], AGE, 60)
