"""Group sums, shares, apportionment and key lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline.catalog.base import Inputs, nullable_number, query
from siltline.catalog.derived import LINE_DETAIL, NATION_TOTALS
from siltline.functions.keys import surrogate_key
from siltline.operators import allocate, quality, star
from siltline.session import settle

DETAIL = f"""
with detail as (
  select year, nation, brand, sum(quantity) as quantity from ({LINE_DETAIL}) as d group by year, nation, brand),
group_weights as (select year, nation, sum(quantity) as group_quantity from detail group by year, nation),
coarse as (select year, nation, sum(price) as price from ({NATION_TOTALS}) as c group by year, nation)
"""


def line_detail(t: Inputs):
    return settle(allocate.sum_by(t.derive(LINE_DETAIL), ["year", "nation", "brand"], {"quantity": "quantity"}), "detail")


@query(
    "f1_detail_with_totals",
    DETAIL + """select detail.year, detail.nation, brand, quantity, group_quantity
    from detail join group_weights on detail.year = group_weights.year and detail.nation = group_weights.nation""",
)
def detail_with_totals(t: Inputs):
    return allocate.share_of_total(line_detail(t), ["year", "nation"], "quantity", total="group_quantity").drop("share")


@query(
    "f2_left_with_default",
    DETAIL + """select detail.year, detail.nation, brand, quantity, cast(coalesce(price, 0) as double) as price
    from detail left join coarse on detail.year = coarse.year and detail.nation = coarse.nation""",
)
def left_with_default(t: Inputs):
    coarse = allocate.sum_by(t.derive(NATION_TOTALS), ["year", "nation"], {"price": "price"})
    return allocate.left_with_default(line_detail(t), coarse, ["year", "nation"], {"price": 0})


# Lines with a zero weight where nothing was discounted, and without a supplier where the line came back.
WEIGHTED = """
select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'R' then null else l_suppkey end as supplier,
  cast(round(l_discount * 100) as int) as weight
from {lineitem}
"""


@query(
    "f3_share_of_total",
    f"""
    select l_orderkey, l_linenumber, l_partkey, supplier, weight, cast(total as bigint) as total, weight / nullif(cast(total as double), 0) as share
    from (select *, sum(weight) over (partition by supplier, weight > 0) as total from ({WEIGHTED}) as w) as s
    where supplier is not null
    """,
)
def share_of_total(t: Inputs):
    rows = t.derive(WEIGHTED).withColumn("heavy", F.col("weight") > 0)
    return allocate.share_of_total(rows, ["supplier", "heavy"], "weight", total="total").drop("heavy")


APPORTIONED = DETAIL + """, allocated as (
select detail.year, detail.nation, brand, quantity,
       (quantity / nullif(group_quantity, 0)) * cast(coalesce(price, 0) as double) as fob, cast(coalesce(price, 0) as double) as total
from detail join group_weights on detail.year = group_weights.year and detail.nation = group_weights.nation
left join coarse on detail.year = coarse.year and detail.nation = coarse.nation)
"""


def apportioned(t: Inputs):
    totals = t.derive(NATION_TOTALS)
    coarse = allocate.sum_by(totals, ["year", "nation"], {"price": "price"}).withColumn("price", F.col("price").cast("double"))
    return allocate.apportion(line_detail(t), coarse, ["year", "nation"], "quantity", "price", "fob", "total")


@query("f4_apportion", APPORTIONED + "select year, nation, brand, quantity, fob, total from allocated")
def apportion(t: Inputs):
    return apportioned(t)


# Facts whose part, customer or year is not in the dimension: small parts and the customers in debt have no
# dimension row, and the calendar ends with the year 1999.
STAR = """
with parts as (select p_partkey, md5(cast(p_partkey as string)) as part_key from {part} where p_type <> 'SMALL'),
customers as (select c_custkey, md5(cast(c_custkey as string)) as customer_key from {customer} where c_acctbal >= 0)
"""


def _dimensions(t: Inputs):
    parts = t.part.where(F.col("p_type") != "SMALL").select("p_partkey", surrogate_key("p_partkey").alias("part_key"))
    owners = t.customer.where(F.col("c_acctbal") >= 0).select("c_custkey", surrogate_key("c_custkey").alias("customer_key"))
    return parts, owners


@query(
    "f5_star_lookup",
    STAR + """
    select l_orderkey, l_linenumber, l_partkey, part_key, customer_key
    from {lineitem} join {orders} on l_orderkey = o_orderkey
    left join parts on l_partkey = p_partkey left join customers on o_custkey = c_custkey
    """,
)
def star_lookup(t: Inputs):
    parts, owners = _dimensions(t)
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    fact = fact.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")
    keyed = star.lookup_keys(fact, [
        star.Lookup(parts, "l_partkey", "p_partkey", "part_key", "first"),
        star.Lookup(owners, "o_custkey", "c_custkey", "customer_key"),
    ])
    return keyed.drop("o_custkey")


@query(
    "f6_year_lookup",
    """
    with days as (select distinct cast(o_orderdate as date) as d from {orders} where year(o_orderdate) < 2000)
    select o_orderkey, cast(year(o_orderdate) as int) as year, cast(d as string) as date_key
    from {orders} left join days on year(o_orderdate) = year(d) and month(d) = 1 and day(d) = 1
    """,
)
def year_lookup(t: Inputs):
    before = t.orders.where(F.year("o_orderdate") < 2000).select(F.col("o_orderdate").cast("date").alias("d"))
    calendar = star.date_dimension(before.distinct(), "d")
    facts = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    keyed = star.lookup_keys(facts, [star.Lookup(star.first_of_year(calendar), "year", "year", "date_key")])
    return keyed.select("o_orderkey", "year", "date_key")


@query(
    "f7_orphans",
    """
    select l_partkey as value, count(*) as n from {lineitem}
    where not exists (select 1 from {part} where p_partkey = l_partkey and p_type <> 'SMALL') group by 1
    """,
)
def orphans(t: Inputs):
    parts, _ = _dimensions(t)
    return quality.orphans(t.lineitem, "l_partkey", parts, "p_partkey")


@query(
    "f8_unallocated",
    DETAIL + """select year, nation, cast(price as double) as price from coarse
    where not exists (select 1 from detail where detail.year = coarse.year and detail.nation = coarse.nation)""",
)
def unallocated(t: Inputs):
    return allocate.unallocated(line_detail(t), t.derive(NATION_TOTALS), ["year", "nation"], "price")


LINE_SUMS = """
select cast(year(l_shipdate) as int) as year, l_returnflag, l_linestatus, l_linenumber,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
from {lineitem} group by 1, 2, 3, 4
"""


def line_sums(t: Inputs):
    lines = t.lineitem.select(
        F.year("l_shipdate").alias("year"), "l_returnflag", "l_linestatus", "l_linenumber",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return allocate.sum_by(lines, ["year", "l_returnflag", "l_linestatus", "l_linenumber"], {"price": "price", "quantity": "quantity"})


@query("g1_sum_by_four_keys", LINE_SUMS)
def sum_by_four_keys(t: Inputs):
    return line_sums(t)


@query(
    "g2_sum_of_sums",
    f"select year, l_returnflag, l_linestatus, cast(sum(cast(price as decimal(18,2))) as double) as price, cast(sum(quantity) as bigint) as quantity from ({LINE_SUMS}) as s group by 1, 2, 3",
)
def sum_of_sums(t: Inputs):
    return allocate.sum_by(line_sums(t), ["year", "l_returnflag", "l_linestatus"], {"price": "price", "quantity": "quantity"})


@query(
    "g3_sum_by_three_keys",
    """
    select cast(year(o_orderdate) as int) as year, o_orderstatus, o_orderpriority, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as price
    from {orders} group by 1, 2, 3
    """,
)
def sum_by_three_keys(t: Inputs):
    orders = t.orders.select(
        F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    return allocate.sum_by(orders, ["year", "o_orderstatus", "o_orderpriority"], {"price": "price"})


@query(
    "h2_partition_total",
    f"select l_orderkey, l_linenumber, l_partkey, cast(supplier as double) as supplier, weight, cast(sum(weight) over (partition by supplier) as bigint) as total from ({WEIGHTED}) as w",
)
def partition_total(t: Inputs):
    totals = allocate.partition_total(t.derive(WEIGHTED), ["supplier"], "weight", "total")
    return totals.withColumn("supplier", nullable_number("supplier"))
