"""Data-quality tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline.catalog.base import Inputs, query
from siltline.catalog.derived import RAW_ORDERS
from siltline.operators import quality

RAW = f"with raw as ({RAW_ORDERS})"
ACCEPTED = ("1-URGENT", "2-HIGH", "5-LOW")


@query(
    "l1_not_null",
    f"{RAW} " + " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where {c} is null) as failures from raw"""
        for c in ("order_id", "day_text", "amount_text", "label_text")
    ),
)
def not_null(t: Inputs):
    return quality.null_counts(t.derive(RAW_ORDERS), ["order_id", "day_text", "amount_text", "label_text"])


@query("l1_null_rows", f"{RAW} select order_id, customer_id, day_text, amount_text from raw where label_text is null")
def null_rows(t: Inputs):
    return quality.not_null(t.derive(RAW_ORDERS), "label_text").drop("label_text")


@query(
    "l2_unique",
    f"{RAW} select amount_text as value, count(*) as n from raw where amount_text is not null group by 1 having count(*) > 1",
)
def unique(t: Inputs):
    return quality.duplicates(t.derive(RAW_ORDERS), "amount_text")


@query(
    "l3_accepted_values",
    f"{RAW} select label_text as value, count(*) as n from raw where label_text not in {ACCEPTED} group by 1",
)
def accepted_values(t: Inputs):
    return quality.unaccepted(t.derive(RAW_ORDERS), "label_text", ACCEPTED)


@query(
    "l4_relationships",
    "select o_custkey as value, count(*) as n from {orders} where not exists (select 1 from {customer} where c_custkey = o_custkey and c_acctbal >= 0) group by 1",
)
def relationships(t: Inputs):
    solvent = t.customer.where(F.col("c_acctbal") >= 0)
    return quality.orphans(t.orders, "o_custkey", solvent, "c_custkey")


@query(
    "l5_suite",
    f"""{RAW}, results as (
      select 'raw' as table_name, 'order_id' as "column", 'not_null' as test, count(*) filter (where order_id is null) as failures from raw
      union all select 'raw', 'label_text', 'not_null', count(*) filter (where label_text is null) from raw
      union all select 'raw', 'order_id', 'unique', count(*) from (select order_id from raw group by 1 having count(*) > 1) as u
      union all select 'raw', 'day_text', 'unique', count(*) from (select day_text from raw where day_text is not null group by 1 having count(*) > 1) as u
      union all select 'raw', 'label_text', 'accepted_values', count(distinct label_text) from raw where label_text not in {ACCEPTED}
      union all select 'raw', 'customer_id', 'relationships', count(*) from raw where not exists (select 1 from {{customer}} where c_acctbal >= 0 and cast(c_custkey as string) = customer_id)
      union all select 'solvent', 'c_custkey', 'not_null', 0)
    select table_name, "column", test, cast(failures as bigint) as failures, case when failures = 0 then 'pass' else 'fail' end as status from results
    """,
)
def suite(t: Inputs):
    solvent = t.customer.where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").cast("string").alias("c_custkey"))
    checks = (
        quality.Suite()
        .add("raw", "order_id", "not_null", "unique")
        .add("raw", "label_text", "not_null")
        .add("raw", "label_text", "accepted_values", values=ACCEPTED)
        .add("raw", "day_text", "unique")
        .add("raw", "customer_id", "relationships", parent="solvent", parent_column="c_custkey")
        .add("solvent", "c_custkey", "not_null")
    )
    return checks.run({"raw": t.derive(RAW_ORDERS), "solvent": solvent})
