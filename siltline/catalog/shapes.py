"""Reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline.catalog.base import Inputs, query
from siltline.catalog.derived import MATRIX_CELLS
from siltline.functions.dates import with_year_month
from siltline.operators import reshape
from siltline.session import settle

NATIONAL = "exportaciones_totales"


def wide_matrix(t: Inputs):
    """The matrix as the source publishes it: a row per year, a column per cell, a subtotal per province and
    a national block with its own grand total. Its size is that of the catalogue of places."""
    province, country = F.col("province"), F.col("country")
    names = F.array(
        F.concat_ws("_", province, country),
        F.concat_ws("_total_", province, province),
        F.concat_ws("_", F.lit(NATIONAL), country),
        F.lit(f"{NATIONAL}_total_general"),
    )
    cells = t.derive(MATRIX_CELLS).select("y", "v", F.explode(names).alias("name"))
    columns = settle(cells.groupBy("y", "name").agg(F.sum("v").alias("v")), "matrix")
    wide = columns.groupBy("y").pivot("name").agg(F.first("v"))
    values = [F.col(f"`{c}`").cast("decimal(18,2)").cast("string").alias(c) for c in wide.columns if c != "y"]
    return wide.select(F.concat(F.col("y").cast("string"), F.lit("-01-01")).alias("indice_tiempo"), *values)


@query(
    "b1_unpivot",
    """
    select l_returnflag, c.col as col, count(*) as n, cast(sum(cast(case c.col when 'l_quantity' then l_quantity when 'l_extendedprice' then l_extendedprice
             when 'l_discount' then l_discount else l_tax end as decimal(18,2))) as double) as total
    from {lineitem} cross join (values ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) as c(col)
    group by 1, 2
    """,
)
def unpivot(t: Inputs):
    measures = t.lineitem.select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    long = reshape.to_long(measures, ["l_returnflag"])
    return long.groupBy("l_returnflag", "col").agg(
        F.count("*").alias("n"), F.sum(F.col("raw_value").cast("decimal(18,2)")).alias("total")
    )


CELLS = f"select concat(cast(y as string), '-01-01') as indice_tiempo, province, country, cast(v as double) as v from ({MATRIX_CELLS}) as cells"
BLOCK = f"""
select concat(cast(y as string), '-01-01') as indice_tiempo, '{NATIONAL}' as province, country, cast(sum(v) as double) as v
from ({MATRIX_CELLS}) as cells group by y, country
"""


def _long(df):
    """Cells the matrix has no figure for are empty."""
    return df.where(F.col("raw_value").isNotNull()).withColumn("v", F.col("raw_value").try_cast("double")).drop("raw_value")


@query(
    "b2_drop_marked",
    f"select indice_tiempo, concat(province, '_', country) as col, v from ({CELLS} union all {BLOCK}) as x",
)
def drop_marked(t: Inputs):
    return _long(reshape.to_long(reshape.drop_marked(wide_matrix(t), "_total_"), ["indice_tiempo"]))


@query("b3_split_prefix", f"{CELLS} union all {BLOCK}")
def split_prefix(t: Inputs):
    return _long(reshape.unpivot_matrix(wide_matrix(t), ["indice_tiempo"]))


@query("b3_split_prefix_excluded", CELLS)
def split_prefix_excluded(t: Inputs):
    return _long(reshape.unpivot_matrix(wide_matrix(t), ["indice_tiempo"], exclude_prefixes=[NATIONAL]))


# Names such as promo_red_widget; the prefixes are the types and, for large parts, the types with a colour.
PREFIX_INPUT = """
with names as (select p_partkey, concat(lower(p_type), '_', replace(p_name, ' ', '_')) as name, p_size from {part}),
prefixes as (
  select distinct lower(p_type) as prefix from {part} where p_type <> 'SMALL'
  union
  select distinct concat(lower(p_type), '_', split_part(p_name, ' ', 1)) as prefix from {part} where p_size > 45 and p_brand = 'Brand#1')
"""


@query(
    "b3_split_by_prefix_table",
    PREFIX_INPUT
    + """, best as (
      select name, max(length(prefix)) as cut from (select distinct name from names) as n
      join prefixes on starts_with(name, concat(prefix, '_')) group by name)
    select p_partkey, coalesce(substr(names.name, 1, cut), 'unknown') as prefix,
           coalesce(substr(names.name, cut + 2), names.name) as rest
    from names left join best on names.name = best.name
    """,
)
def split_by_prefix(t: Inputs):
    kind, words = F.lower("p_type"), F.split("p_name", " ")
    names = t.part.select("p_partkey", F.concat(kind, F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_"))).alias("name"))
    short = t.part.where(F.col("p_type") != "SMALL").select(kind.alias("prefix"))
    large = t.part.where((F.col("p_size") > 45) & (F.col("p_brand") == "Brand#1"))
    coloured = large.select(F.concat(kind, F.lit("_"), words[0]).alias("prefix"))
    split = reshape.split_by_prefix(names, "name", short.union(coloured), "prefix")
    return split.select("p_partkey", "prefix", "rest")


@query(
    "b4_calendar_columns",
    "select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month from {orders}",
)
def calendar_columns(t: Inputs):
    return with_year_month(t.orders, "o_orderdate").select("o_orderkey", "year", "month")


@query("b5_projection", "select c_mktsegment, c_custkey, c_acctbal from {customer}")
def projection(t: Inputs):
    return reshape.project(t.customer, ["c_mktsegment", "c_custkey", "c_acctbal"])
