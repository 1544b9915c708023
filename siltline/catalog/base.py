"""Registry of queries and access to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.session import tune, workspace

# Columns of the given tables. With a stated schema no footer is read while a plan is built.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Inputs:
    """The given tables as frames, and frames that SQL text derives from them.

    In the text, a table is written ``{orders}``. The oracle gets the same text with plain names, so both
    sides start from the same rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{name}.parquet")

    def derive(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{t: getattr(self, t) for t in TABLES if "{" + t + "}" in text})

    def folder(self, label: str) -> str:
        return workspace(self.spark, label)


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def oracle_text(text: str) -> str:
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def query(name: str, sql: str | None):
    """Register ``build(inputs)`` under a name. Dates, times and decimals leave in comparable types."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Inputs(tune(spark), sf_dir.rstrip("/"))))

        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Entry(run, oracle_text(sql) if sql else None)
        return build

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles: types that every client library reads alike."""
    columns = []
    for field in df.schema.fields:
        kind, c = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind == "decimal":
            c = c.cast("double")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def nullable_number(c: str | Column) -> Column:
    """Whole numbers with gaps leave as doubles, the only number type in which client libraries agree on gaps."""
    return (F.col(c) if isinstance(c, str) else c).cast("double")
