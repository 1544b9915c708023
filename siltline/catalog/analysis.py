"""Profiles, ranks and change over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline.catalog.base import Inputs, query
from siltline.catalog.derived import RAW_ORDERS
from siltline.operators import analytics, dedup, profile
from siltline.sources import landing, tree_profile

# Orders with gaps: the first rows in key order have no priority, and no row has a comment.
PROFILED = """
select o_orderkey, case when o_orderstatus <> 'P' then o_orderpriority end as priority,
  case when o_totalprice > 250000 then cast(o_totalprice as decimal(18,2)) end as price,
  case when o_orderstatus = 'F' then concat('a|', o_orderpriority, '|', repeat(o_orderstatus, 78)) end as note,
  cast(null as string) as comment
from {orders}
"""
PROFILE_COLUMNS = [
    ("o_orderkey", "bigint"), ("priority", "string"), ("price", "decimal(18,2)"), ("note", "string"), ("comment", "string"),
]
PROFILE = f"with p as ({PROFILED}) " + " union all ".join(
    f"""
    select '{c}' as "column", {i + 1} as position, '{dtype}' as dtype, count(*) as rows, {len(PROFILE_COLUMNS)} as columns,
      round((count(*) - count({c})) * 100.0 / count(*), 1)::double as null_pct,
      coalesce(arg_min(cast({c} as string), o_orderkey) filter (where {c} is not null), '—') as sample from p
    """
    for i, (c, dtype) in enumerate(PROFILE_COLUMNS)
)


@query("g4_profile", PROFILE)
def table_profile(t: Inputs):
    return profile.profile(t.derive(PROFILED), ["o_orderkey"])


TEXTS = ["order_id", "customer_id", "day_text", "amount_text", "label_text"]


@query(
    "g4_profile_raw",
    f"with raw as ({RAW_ORDERS}) " + " union all ".join(
        f"""
        select '{c}' as "column", case when count(*) filter (where {c} is not null and try_cast({c} as bigint) is null) = 0 then 'bigint'
          when count(*) filter (where {c} is not null and try_cast({c} as double) is null) = 0 then 'double' else 'string' end as dtype,
          round((count(*) - count({c})) * 100.0 / count(*), 1)::double as null_pct,
          arg_min({c}, cast(order_id as bigint)) filter (where {c} is not null) as sample from raw
        """
        for c in TEXTS
    ),
)
def raw_profile(t: Inputs):
    raw = t.derive(RAW_ORDERS).withColumn("seq", F.col("order_id").cast("bigint"))
    found = profile.profile(raw, ["seq"], infer_text=True)
    return found.where(F.col("column") != "seq").select("column", "dtype", "null_pct", "sample")


# Raw files of three headers: orders by month, customers by nation, parts by brand.
TREE = {
    "month": ("o_orderkey", """
select substr(cast(cast(o_orderdate as date) as string), 1, 7) as month, o_orderkey, cast(o_orderkey as string) as order_id,
  case when o_orderstatus <> 'P' then o_orderpriority end as priority, case when o_totalprice > 250000 then cast(cast(o_totalprice as decimal(18,2)) as string) end as price,
  cast(null as string) as comment from {orders}"""),
    "nation": ("c_custkey", """
select n_name as nation, c_custkey, case when c_acctbal < 0 then concat(c_mktsegment, ', "', c_name, '"') end as note, cast(c_custkey as string) as customer from {customer} join {nation} on c_nationkey = n_nationkey"""),
    "brand": ("p_partkey", """
select p_brand as brand, p_partkey, p_name as name, case when p_size > 10 then cast(p_size as string) end as size, cast(cast(p_retailprice as decimal(18,2)) as string) as price,
  case when p_type <> 'PROMO' then p_type end as kind from {part}"""),
}
TREE_COLUMNS = {"month": ["order_id", "priority", "price", "comment"], "nation": ["note", "customer"], "brand": ["name", "size", "price", "kind"]}


def _tree_sql() -> str:
    lines = []
    for folder, (key, text) in TREE.items():
        for i, c in enumerate(TREE_COLUMNS[folder]):
            lines.append(f"""
    select concat('{folder}=', {folder}) as file, '{c}' as "column", cast({i + 1} as int) as position,
      case when count({c}) = 0 then 'string' when count(*) filter (where not regexp_full_match({c}, '[+-]?[0-9]+')) = 0 then 'bigint'
        when count(*) filter (where {c} is not null and try_cast({c} as double) is null) = 0 then 'double' else 'string' end as dtype,
      count(*) as rows, cast({len(TREE_COLUMNS[folder])} as int) as columns, round((count(*) - count({c})) * 100.0 / count(*), 1)::double as null_pct,
      coalesce(arg_min({c}, {key}) filter (where {c} is not null), '—') as sample from ({text}) as t group by {folder}""")
    return " union all ".join(lines)


@query("g4_profile_by_file", _tree_sql())
def profile_by_file(t: Inputs):
    """One file for each month, nation and brand, in the order of the keys."""
    root = t.folder("g4_tree")
    for folder, (key, text) in TREE.items():
        rows = t.derive(text).repartition(folder).sortWithinPartitions(folder, key)
        landing.write_csv(rows.select(folder, *TREE_COLUMNS[folder]), root, "append", [folder])
    found = tree_profile.profile_files(t.spark, root)
    folder = F.regexp_extract("file", "/([^/]+)/[^/]+$", 1)
    return found.withColumn("file", F.url_decode(F.url_decode(folder)))  # escaped as a value of a partition, and again in the path


@query(
    "g4_head",
    "select o_orderkey, o_custkey, o_orderpriority from {orders} order by o_custkey, o_orderkey limit 3",
)
def head(t: Inputs):
    return profile.head(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey", "o_orderkey"])


@query(
    "g5_report_lines",
    f"""
    select position, concat('| `', "column", '` | ', dtype, ' | ', cast(null_pct as string), '% | ',
      substr(replace(sample, '|', '\\|'), 1, 80), ' |') as line from ({PROFILE}) as q
    """,
)
def report_lines(t: Inputs):
    return profile.report_lines(profile.profile(t.derive(PROFILED), ["o_orderkey"]))


@query(
    "h1_row_number",
    """
    select o_custkey, o_orderkey, rn from (
      select *, cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as int) as rn from {orders}) as r
    where rn <= 3
    """,
)
def row_number(t: Inputs):
    numbered = dedup.top_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3, rank_column="rn")
    return numbered.select("o_custkey", "o_orderkey", "rn")


YEARLY = """
select o_custkey, cast(year(o_orderdate) as int) as year, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spent
from {orders} group by 1, 2
"""


@query(
    "h3_change_by_year",
    f"select o_custkey, year, spent, spent - lag(spent) over (partition by o_custkey order by year) as change from ({YEARLY}) as y",
)
def change_by_year(t: Inputs):
    return analytics.change_by_period(t.derive(YEARLY), ["o_custkey"], "year", "spent")


@query(
    "h4_top_ranked",
    """
    select p_brand, l_suppkey, quantity, rank from (
      select *, cast(rank() over (partition by p_brand order by quantity desc) as int) as rank from (
        select p_brand, l_suppkey, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
        from {lineitem} join {part} on l_partkey = p_partkey group by 1, 2) as s) as r
    where rank <= 3
    """,
)
def top_ranked(t: Inputs):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    sold = lines.groupBy("p_brand", "l_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    return analytics.top_ranked(sold, ["p_brand"], [F.col("quantity").desc()], 3)
