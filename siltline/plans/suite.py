"""Quality suite of the silver tables, the staging views and the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from siltline.operators.quality import Suite
from siltline.plans.constants import OTHER_CATEGORY, PRODUCT_CATEGORIES

# The columns each table must have filled.
FILLED = {
    "indec_exports": ["year", "province", "country", "fob_usd"],
    "senasa_certs": ["provincia", "pais_destino"],
    "worldbank_indicators": ["indicator_code", "country_code", "year", "value"],
    "weather_daily_readings": ["date", "province"],
    "stg_indec_exports": ["year", "province", "country", "fob_usd"],
    "stg_senasa_certs": ["province", "country"],
    "stg_worldbank_prices": ["indicator_code", "indicator_name", "year", "indicator_value"],
    "stg_weather_readings": ["date", "province"],
    "dim_date": ["date_key", "year", "quarter", "month", "week", "year_quarter"],
    "dim_product": ["product_key", "commodity", "product_category", "commodity_english"],
    "dim_province": ["province_key", "province", "is_pampa_region", "main_crop"],
    "dim_destination": ["destination_key", "country_iso2", "country", "continent"],
    "fct_exports": ["export_key", "date_key", "product_key", "province_key", "year", "total_tn"],
}

# The columns that must not repeat a value.
UNIQUE = {
    "dim_date": ["date_key"],
    "dim_product": ["product_key", "commodity"],
    "dim_province": ["province_key", "province"],
    "dim_destination": ["destination_key"],
    "fct_exports": ["export_key"],
}

# Parent of each foreign key of the fact. The destination may be unknown and is not tested.
PARENTS = {"date_key": "dim_date", "product_key": "dim_product", "province_key": "dim_province"}


def export_suite(only: Mapping[str, object] | None = None) -> Suite:
    """All checks, or those of the tables in ``only``."""
    wanted = lambda table: only is None or table in only
    suite = Suite()
    for table, columns in FILLED.items():
        for column in columns if wanted(table) else []:
            suite.add(table, column, "not_null")
    for table, columns in UNIQUE.items():
        for column in columns if wanted(table) else []:
            suite.add(table, column, "unique")
    if wanted("dim_date"):
        suite.add("dim_date", "quarter", "accepted_values", values=(1, 2, 3, 4))
    if wanted("dim_product"):
        categories = (*PRODUCT_CATEGORIES, OTHER_CATEGORY)
        suite.add("dim_product", "product_category", "accepted_values", values=categories)
    for column, parent in PARENTS.items():
        if wanted("fct_exports") and wanted(parent):
            suite.add("fct_exports", column, "relationships", parent=parent, parent_column=column)
    return suite


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return export_suite(tables).run(tables)
