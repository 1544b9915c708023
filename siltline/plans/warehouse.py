"""The whole run: silver tables in, history advanced, dimensions and fact written, suite evaluated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from siltline.plans import gold, staging, suite
from siltline.session import scope
from siltline.sources import history
from siltline.sources.schemas import SILVER_COLUMNS, silver_table

MODELS = ["dim_date", "dim_product", "dim_province", "dim_destination", "fct_exports"]


def silver_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(silver_table(name).schema).parquet(f"{root}/{name}") for name in SILVER_COLUMNS}


def staging_views(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_indec_exports": staging.stg_indec_exports(silver["indec_exports"]),
        "stg_senasa_certs": staging.stg_senasa_certs(silver["senasa_certs"]),
        "stg_worldbank_prices": staging.stg_worldbank_prices(silver["worldbank_indicators"]),
        "stg_weather_readings": staging.stg_weather_readings(silver["weather_daily_readings"]),
    }


def _write(df: DataFrame, root: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{root}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")


def build(spark: SparkSession, silver_root: str, gold_root: str, run_ts: datetime) -> dict[str, DataFrame]:
    """Write the models below ``gold_root`` and return them with the silver tables and staging views.

    A run that is repeated with the same ``run_ts`` gives the same tables and the same history.
    """
    with scope(spark):  # what steps settle on the way goes when all models are written
        silver = silver_tables(spark, silver_root)
        views = staging_views(silver)
        snap, key = f"{gold_root}/snap_destination", "country_iso2"
        incoming = gold.destinations(silver["senasa_certs"])
        history.advance(spark, snap, incoming, key, ["country", "continent"], run_ts, gold.HISTORY)
        certs = views["stg_senasa_certs"]
        tables = {
            "dim_date": _write(gold.dim_date(spark), gold_root, "dim_date"),
            "dim_product": _write(gold.dim_product(certs), gold_root, "dim_product"),
            "dim_province": _write(gold.dim_province(certs), gold_root, "dim_province"),
            "dim_destination": _write(gold.dim_destination(history.read_current(spark, snap)), gold_root, "dim_destination"),
        }
        enriched = gold.int_exports_enriched(
            staging.stg_senasa_certs(silver["senasa_certs"], measure=staging.EXACT),
            staging.stg_indec_exports(silver["indec_exports"], measure=staging.EXACT),
        )
        fact = gold.fct_exports(
            enriched, tables["dim_date"], tables["dim_destination"], tables["dim_product"], tables["dim_province"]
        )
        tables["fct_exports"] = _write(fact, gold_root, "fct_exports")
        return silver | views | tables


def check(spark: SparkSession, silver_root: str, gold_root: str) -> DataFrame:
    """The suite over stored tables."""
    silver = silver_tables(spark, silver_root)
    models = {name: spark.read.parquet(f"{gold_root}/{name}") for name in MODELS}
    return suite.check_tables(silver | staging_views(silver) | models)
