"""Schemas of the worked example: raw columns, silver tables and the partition columns of each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names and types of the raw files and of the silver tables.
RAW_COLUMNS = {
    "senasa_certs": [
        "fecha", "oficina_cf", "provincia", "provincia_id", "pais_destino", "pais_destino_id",
        "pais_destino_id_iso_3166_1", "continente", "mercaderia_certificada", "transporte", "tn",
    ],
    "worldbank_indicators": ["country", "country_code", "indicator", "indicator_code", "year", "value"],
    "weather_daily_readings": [
        "date", "province", "latitude", "longitude", "temp_max_c", "temp_min_c",
        "precipitation_mm", "wind_speed_max_kmh", "evapotranspiration_mm",
    ],
}

TEXT, WHOLE, DATE, MONEY = T.StringType(), T.IntegerType(), T.DateType(), T.DecimalType(18, 4)

SILVER_COLUMNS = {
    "indec_exports": [("year", WHOLE), ("province", TEXT), ("country", TEXT), ("fob_usd", MONEY)],
    "senasa_certs": [
        ("fecha", DATE), ("oficina_cf", TEXT), ("provincia", TEXT), ("provincia_id", WHOLE), ("pais_destino", TEXT),
        ("pais_destino_id", WHOLE), ("pais_destino_id_iso_3166_1", TEXT), ("continente", TEXT),
        ("mercaderia_certificada", TEXT), ("transporte", TEXT), ("tn", MONEY), ("year", WHOLE), ("month", WHOLE),
    ],
    "worldbank_indicators": [
        ("country", TEXT), ("country_code", TEXT), ("indicator", TEXT), ("indicator_code", TEXT),
        ("year", WHOLE), ("value", T.DecimalType(18, 6)),
    ],
    "weather_daily_readings": [
        ("date", DATE), ("province", TEXT), ("latitude", T.DecimalType(8, 5)), ("longitude", T.DecimalType(8, 5)),
        ("temp_max_c", T.DecimalType(6, 2)), ("temp_min_c", T.DecimalType(6, 2)),
        ("precipitation_mm", T.DecimalType(8, 2)), ("wind_speed_max_kmh", T.DecimalType(6, 2)),
        ("evapotranspiration_mm", T.DecimalType(8, 2)), ("year", WHOLE), ("month", WHOLE),
    ],
}

PARTITIONS = {
    "indec_exports": ["year"],
    "senasa_certs": ["year", "month"],
    "worldbank_indicators": ["year"],
    "weather_daily_readings": ["year", "month"],
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    partition_by: list[str]


def silver_table(name: str) -> TableSpec:
    schema = T.StructType([T.StructField(column, kind) for column, kind in SILVER_COLUMNS[name]])
    return TableSpec(name, schema, PARTITIONS[name])
