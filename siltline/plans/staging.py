"""Staging views: renamed, cast and normalised silver tables. Nothing is materialised."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.functions.text import canonical_key, normal_key
from siltline.plans.constants import INDICATOR_COUNTRY, PLACE_ALIASES

#: The views show doubles; what adds measures up takes them exact, so that no order of the rows shows in a sum.
EXACT = "decimal(18,4)"


def place_key(c: str) -> Column:
    """Key under which both export sources meet although they spell places differently."""
    return canonical_key(c, PLACE_ALIASES)


def stg_indec_exports(silver: DataFrame, place: Callable[[str], Column] = normal_key, measure: str = "double") -> DataFrame:
    return silver.select(
        F.col("year").cast("int").alias("year"),
        place("province").alias("province"),
        place("country").alias("country"),
        F.col("fob_usd").cast(measure).alias("fob_usd"),
    )


def stg_senasa_certs(silver: DataFrame, place: Callable[[str], Column] = normal_key, measure: str = "double") -> DataFrame:
    return silver.select(
        F.col("year").cast("int").alias("year"),
        place("provincia").alias("province"),
        place("pais_destino").alias("country"),
        F.col("pais_destino_id_iso_3166_1").alias("country_iso2"),
        normal_key("mercaderia_certificada").alias("commodity"),
        F.col("tn").cast(measure).alias("total_tn"),
    )


def stg_worldbank_prices(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("country_code") == INDICATOR_COUNTRY).select(
        "indicator_code",
        F.col("indicator").alias("indicator_name"),
        F.col("year").cast("int").alias("year"),
        F.col("value").cast("double").alias("indicator_value"),
    )


def stg_weather_readings(silver: DataFrame) -> DataFrame:
    measures = ["temp_max_c", "temp_min_c", "precipitation_mm"]
    return silver.select(
        F.col("date").cast("date").alias("date"),
        normal_key("province").alias("province"),
        *[F.col(m).cast("double").alias(m) for m in measures],
    )
