"""From landed API payloads to raw rows, and the list of what is still to be requested."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.plans import constants as K
from siltline.sources import landing, payload
from siltline.sources.schemas import RAW_COLUMNS


def weather_requests(spark: SparkSession, end: date, ledger: DataFrame | None = None) -> DataFrame:
    """Stations with the year before ``end`` and their landing key, without those the ledger holds.

    ``ledger`` has one column ``landing_key``.
    """
    stations = spark.createDataFrame(K.STATIONS, "province string, latitude double, longitude double")
    requests = payload.rolling_requests(stations, end)
    name = F.concat(F.lit("weather_"), F.col("province"), F.lit(".csv"))
    keyed = requests.withColumn("landing_key", landing.landing_key("weather", end, name))
    return keyed if ledger is None else landing.pending(keyed, ledger, "landing_key")


def indicator_requests(spark: SparkSession) -> DataFrame:
    """(indicator, indicator_code) of the indicators to request."""
    return spark.createDataFrame(list(K.INDICATORS.items()), "indicator string, indicator_code string")


def weather_rows(payloads: DataFrame) -> DataFrame:
    """Payloads (province, latitude, longitude, body) to raw weather rows; every column a text."""
    places = payloads.withColumns({c: F.col(c).cast("string") for c in ("latitude", "longitude")})
    rows = payload.zip_columns(places, "body", K.WEATHER_FIELDS, ["province", "latitude", "longitude"])
    return rows.select(*RAW_COLUMNS["weather_daily_readings"])


def indicator_rows(payloads: DataFrame) -> DataFrame:
    """Payloads (indicator, indicator_code, body) to raw indicator rows, sorted for the file they become."""
    rows = payload.flatten_records(payloads, "body", "indicator", "indicator_code")
    return payload.concat_sorted([rows.select(*RAW_COLUMNS["worldbank_indicators"])], ["indicator", "year"])


def file_resource(payloads: DataFrame, source: str, day: date, default_name: str) -> DataFrame:
    """Catalogue payloads (body and any columns) to the file to fetch and the key it is landed under."""
    found = payload.pick_resource(payloads, "body", default_name)
    key = landing.landing_key(source, day, F.col("file_name"))
    return found.withColumn("landing_key", F.when(F.col("status") == "ok", key))


#: Payloads by source: their columns, and what they become.
PAYLOADS = {
    "weather": ("province string, latitude double, longitude double, body string", weather_rows),
    "worldbank": ("indicator string, indicator_code string, body string", indicator_rows),
}


def ingest(spark: SparkSession, source: str, payloads: str, root: str, ledger: str, day: date, ingested_at: datetime) -> str:
    """Payload files (JSON lines) to raw rows, landed once for a source, month and file name; returns the status.

    A payload that is malformed adds no rows. The ledger says where the rows came from.
    """
    columns, rows_of = PAYLOADS[source]
    rows = rows_of(spark.read.schema(columns).json(payloads))
    return landing.land_once(rows, root, source, day, f"{source}.csv", ledger, ingested_at, payloads=payloads)
