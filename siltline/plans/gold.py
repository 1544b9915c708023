"""Intermediate model, dimensions and fact of the star schema."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.functions.keys import surrogate_key
from siltline.functions.labels import label_by_keyword, label_of, renamed_value
from siltline.functions.text import normal_key
from siltline.operators import scd
from siltline.operators.allocate import apportion, sum_by
from siltline.operators.star import Lookup, date_dimension, date_spine, first_of_year, lookup_keys
from siltline.plans import constants as K
from siltline.session import settle

PLACE_YEAR = ["year", "province", "country"]
HISTORY = scd.Validity("dbt_valid_from", "dbt_valid_to", "dbt_updated_at")


def int_exports_enriched(stg_certs: DataFrame, stg_exports: DataFrame) -> DataFrame:
    """Export value per product: the value of a place and year, spread over its products by tonnes.

    Staging rows with ``measure=staging.EXACT`` are added up as decimals and leave as doubles.
    """
    detail = settle(sum_by(stg_certs, [*PLACE_YEAR, "commodity"], {"total_tn": "total_tn"}), "detail")
    spread = apportion(detail, stg_exports, PLACE_YEAR, "total_tn", "fob_usd", "fob_usd", "total_fob_usd")
    return spread.withColumns({c: F.col(c).cast("double") for c in ("total_tn", "total_fob_usd")})


def dim_product(stg_certs: DataFrame, keyword_match: bool = False) -> DataFrame:
    """Products with category and English name. ``keyword_match`` also files phrases that hold a product name."""
    names = stg_certs.where(F.col("commodity").isNotNull()).select(normal_key("commodity").alias("commodity")).distinct()
    category = label_by_keyword if keyword_match else label_of
    return names.select(
        surrogate_key("commodity").alias("product_key"),
        "commodity",
        category("commodity", K.PRODUCT_CATEGORIES, K.OTHER_CATEGORY).alias("product_category"),
        renamed_value("commodity", K.PRODUCT_NAMES).alias("commodity_english"),
    )


def dim_province(stg_certs: DataFrame) -> DataFrame:
    names = stg_certs.where(F.col("province").isNotNull()).select(normal_key("province").alias("province")).distinct()
    return names.select(
        surrogate_key("province").alias("province_key"),
        "province",
        F.col("province").isin(*K.PAMPA_PROVINCES).alias("is_pampa_region"),
        label_of("province", K.MAIN_CROPS, K.OTHER_CROP).alias("main_crop"),
    )


def destinations(certs: DataFrame) -> DataFrame:
    """Distinct destinations with a code, the input of the destination history."""
    coded = certs.where(F.col("pais_destino_id_iso_3166_1").isNotNull())
    return coded.select(
        F.col("pais_destino_id_iso_3166_1").alias("country_iso2"),
        normal_key("pais_destino").alias("country"),
        normal_key("continente").alias("continent"),
    ).distinct()


def snap_destination(certs: DataFrame, run_ts: datetime | Column, history: DataFrame | None = None) -> DataFrame:
    """Destination history after a run at ``run_ts``; without a history this is the first run."""
    rows, key, compared = destinations(certs), "country_iso2", ["country", "continent"]
    if history is None:
        return scd.initial(rows, key, compared, run_ts, HISTORY)
    return scd.snapshot(history, rows, key, compared, run_ts, HISTORY)


def dim_destination(history: DataFrame) -> DataFrame:
    rows = scd.current_rows(history, "country_iso2", HISTORY)
    return rows.select(surrogate_key("country_iso2").alias("destination_key"), "country_iso2", "country", "continent")


def dim_date(spark: SparkSession, start: str = K.DATES_FROM, until: str = K.DATES_UNTIL) -> DataFrame:
    return date_dimension(date_spine(spark, date.fromisoformat(start), date.fromisoformat(until)))


def fct_exports(
    enriched: DataFrame,
    dates: DataFrame,
    destination: DataFrame,
    product: DataFrame,
    province: DataFrame,
    destination_duplicates: str = "fan_out",
) -> DataFrame:
    """Annual fact. Destinations are found by name, which several codes may share: by default such a fact
    row is repeated; ``first`` and ``error`` are the other choices. ``total_fob_usd`` repeats per product
    and must not be added up over products."""
    keyed = lookup_keys(enriched, [
        Lookup(first_of_year(dates), "year", "year", "date_key"),
        Lookup(destination, "country", "country", "destination_key", destination_duplicates),
        Lookup(product, "commodity", "commodity", "product_key"),
        Lookup(province, "province", "province", "province_key"),
    ])
    return keyed.select(
        surrogate_key(*PLACE_YEAR, "commodity").alias("export_key"),
        "date_key", "destination_key", "product_key", "province_key",
        "year", "total_tn", "fob_usd", "total_fob_usd",
    )
