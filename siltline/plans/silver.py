"""Raw frames to silver tables. Reading and writing are left to the caller, so the same function serves
batch jobs, micro-batches and tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.functions.casts import to_date_or_null, to_decimal_or_null, to_int_or_null
from siltline.functions.dates import with_year_month
from siltline.functions.text import strip_columns
from siltline.operators import dedup
from siltline.operators.reshape import project, unpivot_matrix
from siltline.operators.validate import in_range, keep_valid, non_negative_or_null, not_blank, positive, required
from siltline.plans.constants import EXPORT_YEARS, INDICATOR_YEARS
from siltline.session import scope, settle
from siltline.sources.raw_csv import FILE, POSITION, read_raw_csv
from siltline.sources.schemas import RAW_COLUMNS, silver_table
from siltline.sources.tables import create_table, empty_partitions, overwrite_partitions, overwrite_table

EXPORT_RULES = [
    required("fob_usd"), positive("fob_usd"), not_blank("province"), not_blank("country"),
    in_range("year", *EXPORT_YEARS),
]
CERT_RULES = [required("fecha"), not_blank("pais_destino"), non_negative_or_null("tn")]
INDICATOR_RULES = [
    required("value"), positive("value"), not_blank("country_code"), not_blank("indicator_code"),
    required("year"), in_range("year", *INDICATOR_YEARS),
]
READING_RULES = [required("date"), required("province")]

CERT_TEXTS = [
    "oficina_cf", "provincia", "pais_destino", "pais_destino_id_iso_3166_1", "continente",
    "mercaderia_certificada", "transporte",
]


def typed_exports(long: DataFrame) -> DataFrame:
    typed = long.withColumns({
        "fob_usd": to_decimal_or_null("raw_value", 18, 4),
        "indice_tiempo": to_date_or_null("indice_tiempo"),
    })
    return with_year_month(typed, "indice_tiempo", month=False)


def newest_cells(typed: DataFrame, landing: str, whole_years: bool = False) -> DataFrame:
    """One row for each (year, province, country): that of its newest landing, whatever its value. Should a landing hold a
    cell twice, the later row counts, by file and place in the file where the frame has them.

    With ``whole_years`` the newest landing that has a year replaces all of it, so cells that it lacks are gone. There is a row for each calendar
    year in the table of newest landings, which is therefore broadcast.
    """
    order = [landing, *(c for c in POSITION if c in typed.columns), "raw_value", "fob_usd"]
    if whole_years:
        newest = typed.where(F.col("year").isNotNull()).groupBy("year").agg(F.max(landing).alias(landing))
        typed = typed.join(F.broadcast(newest), ["year", landing])
    return dedup.latest_per_key(typed, ["year", "province", "country"], order)


def exports_from_long(long: DataFrame, landing: str | None = None, whole_years: bool = False) -> DataFrame:
    """(indice_tiempo, province, country, raw_value) to indec_exports.

    ``landing`` names a column that grows with the landings; cells are then taken as ``newest_cells`` says, before any
    rule: a value revised to nothing leaves no row. Without it all landings count, repeated ones too.
    """
    typed = typed_exports(long)
    if landing:
        typed = newest_cells(typed, landing, whole_years)
    return project(keep_valid(typed, EXPORT_RULES), silver_table("indec_exports").schema.names)


def long_exports(matrix: DataFrame, exclude_prefixes: Sequence[str] = (), landing: str | None = None) -> DataFrame:
    ids = ["indice_tiempo", *([landing] if landing else []), *(c for c in POSITION if c in matrix.columns)]
    return unpivot_matrix(matrix, ids, exclude_prefixes=exclude_prefixes)


def indec_exports(matrix: DataFrame, exclude_prefixes: Sequence[str] = (), landing: str | None = None, whole_years: bool = False) -> DataFrame:
    """The wide matrix to indec_exports. The national block counts as a province unless it is excluded."""
    return exports_from_long(long_exports(matrix, exclude_prefixes, landing), landing, whole_years)


def with_landing(raw: DataFrame) -> DataFrame:
    """``landing``: the folder ``year=/month=`` of the file of a row."""
    return raw.withColumn("landing", F.regexp_extract(FILE, "(year=[^/]+/month=[^/]+)/", 1))


def typed_certs(raw: DataFrame) -> DataFrame:
    return strip_columns(raw, CERT_TEXTS).withColumns({
        "fecha": to_date_or_null("fecha"),
        "provincia_id": to_int_or_null("provincia_id"),
        "pais_destino_id": to_int_or_null("pais_destino_id"),
        "tn": to_decimal_or_null("tn", 18, 4),
    })


def senasa_certs(raw: DataFrame) -> DataFrame:
    """Equal rows are merged after the cast, so ``5000`` and ``5000.0`` are the same certificate. Year and
    month follow from the date and are added after the merge, to keep them out of its shuffle."""
    valid = keep_valid(typed_certs(raw), CERT_RULES)
    merged = dedup.exact(project(valid, RAW_COLUMNS["senasa_certs"]))
    return project(with_year_month(merged, "fecha"), silver_table("senasa_certs").schema.names)


def worldbank_indicators(raw: DataFrame, order_by: Sequence[str | Column] = POSITION) -> DataFrame:
    typed = raw.withColumns({"year": to_int_or_null("year"), "value": to_decimal_or_null("value", 18, 6)})
    valid = keep_valid(typed, INDICATOR_RULES)
    first = dedup.first_per_key(valid, ["country_code", "indicator_code", "year"], order_by)
    return project(first, silver_table("worldbank_indicators").schema.names)


def weather_daily_readings(raw: DataFrame, order_by: Sequence[str | Column] = POSITION) -> DataFrame:
    spec = silver_table("weather_daily_readings")
    numbers = {
        f.name: to_decimal_or_null(f.name, f.dataType.precision, f.dataType.scale)
        for f in spec.schema.fields
        if f.dataType.typeName() == "decimal"
    }
    typed = raw.withColumns({"date": to_date_or_null("date"), **numbers})
    first = dedup.first_per_key(keep_valid(typed, READING_RULES), ["date", "province"], order_by)
    return project(with_year_month(first, "date"), spec.schema.names)


def silver_of(name: str, raw: DataFrame, exclude_prefixes: Sequence[str] = ()) -> DataFrame:
    """Silver form of a frame that was read with positions. Prefixes that are no province are for the wide matrix."""
    plans = {
        "indec_exports": lambda: indec_exports(raw.drop(*POSITION), exclude_prefixes),
        "senasa_certs": lambda: senasa_certs(raw.drop(*POSITION)),
        "worldbank_indicators": lambda: worldbank_indicators(raw),
        "weather_daily_readings": lambda: weather_daily_readings(raw),
    }
    return plans[name]()


def refresh(
    spark: SparkSession, name: str, bronze: str, target: str, table: str | None = None, using: str = "parquet",
    exclude_prefixes: Sequence[str] = (), newest_landing: bool = False, whole_years: bool = False,
) -> DataFrame:
    """Read the raw tree, build the silver table, overwrite its partitions and return it as stored.

    ``table`` is a catalog name; without it the files below ``target`` are the table. Columns are bound by the header
    of each file; the wide matrix has no fixed columns, so all that its landings have are taken. With ``newest_landing``
    (for the wide matrix) only the newest landing of each cell counts, with ``whole_years`` that of each year; a year of which nothing
    is left is emptied. All can be repeated.
    """
    if (newest_landing or whole_years) and name != "indec_exports":
        raise ValueError(f"{name} has no cells that a landing revises")
    spec = silver_table(name)
    raw = read_raw_csv(spark, bronze, RAW_COLUMNS.get(name), position=True)
    with scope(spark):
        gone = None
        if newest_landing or whole_years:
            typed = typed_exports(long_exports(with_landing(raw), exclude_prefixes, "landing"))
            cells = settle(newest_cells(typed, "landing", whole_years), "cells")
            rows = project(keep_valid(cells, EXPORT_RULES), spec.schema.names)
            gone = cells.select("year").where("year is not null").distinct().join(rows.select("year").distinct(), "year", "left_anti")
        else:
            rows = silver_of(name, raw, exclude_prefixes)
        if table:
            create_table(spark, table, spec.schema, spec.partition_by, target, using)
            overwrite_table(rows, table, spec.partition_by, using)
        else:
            overwrite_partitions(rows, target, spec.partition_by)
        if gone is not None:
            empty_partitions(gone, target, table)
    return spark.table(table) if table else spark.read.schema(spec.schema).parquet(target)
