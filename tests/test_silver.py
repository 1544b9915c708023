from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltline.plans import silver
from siltline.plans.constants import EXPORT_YEARS, INDICATOR_YEARS
from siltline.sources import landing
from siltline.sources.schemas import RAW_COLUMNS, silver_table
from tests.conftest import tuples

EXPORTS = {
    "indice_tiempo": ["2004-05-01", "2011-09-01"], "province": ["salta", "neuquen"],
    "country": ["chile", "india"], "raw_value": ["812.25", "640"],
}
CERTS = {
    "fecha": ["2019-11-02", "2021-04-30"], "oficina_cf": ["Bahia", "Posadas"],
    "provincia": ["Chubut", "Misiones"], "provincia_id": ["26", "54.0"], "pais_destino": ["India", "Chile"],
    "pais_destino_id": ["356", "152.0"], "pais_destino_id_iso_3166_1": ["IN", "CL"],
    "continente": ["Asia", "Sur"], "mercaderia_certificada": ["Lana", "Yerba"],
    "transporte": ["BARCO", "TREN|CONT"], "tn": ["73.0", "8.25"],
}
INDICATORS = {
    "country": ["Chile", "India"], "country_code": ["CHL", "IND"], "indicator": ["Wool"] * 2,
    "indicator_code": ["WOOL"] * 2, "year": ["2003", "2016"], "value": ["17.125", "64"],
}
READINGS = {
    "date": ["2022-08-09", "2022-10-11"], "province": ["chubut", "salta"], "latitude": ["-43.3", "-24.78"],
    "longitude": ["-65.1", "-65.41"], "temp_max_c": ["11.5", "26.25"], "temp_min_c": ["-2.5", "9"],
    "precipitation_mm": ["0.75", "12"], "wind_speed_max_kmh": ["61", "14.5"], "evapotranspiration_mm": ["1.25", "3.5"],
}


def raw(spark, columns, **instead):
    """Text rows from lists by column, numbered in ``seq``."""
    columns = columns | instead
    kind = ", ".join(f"{name} string" for name in columns) + ", seq int"
    return spark.createDataFrame([(*row, n) for n, row in enumerate(zip(*columns.values(), strict=True))], kind)


@pytest.mark.parametrize("changes,left", [
    ({"raw_value": ["n/a", "640"]}, "india"),
    ({"raw_value": ["-inf", "640"]}, "india"),
    ({"raw_value": ["0.0", "640"]}, "india"),
    ({"raw_value": ["0.00004", "640"]}, "india"),
    ({"raw_value": ["-7", "640"]}, "india"),
    ({"raw_value": [None, "640"]}, "india"),
    ({"province": [None, "neuquen"]}, "india"),
    ({"province": [" ", "neuquen"]}, "india"),
    ({"country": [None, "india"]}, "india"),
    ({"country": ["\n", "india"]}, "india"),
    ({"indice_tiempo": [f"{EXPORT_YEARS[0] - 1}-12-31", "2011-09-01"]}, "india"),
    ({"indice_tiempo": [f"{EXPORT_YEARS[1] + 1}-01-01", "2011-09-01"]}, "india"),
    ({"indice_tiempo": ["May", "2011-09-01"]}, "india"),
])
def test_export_rules(spark, changes, left):
    assert tuples(silver.exports_from_long(raw(spark, EXPORTS, **changes)), "country") == [(left,)]


def test_exports_schema_and_years(spark):
    out = silver.exports_from_long(raw(spark, EXPORTS))
    assert out.dtypes == [("year", "int"), ("province", "string"), ("country", "string"), ("fob_usd", "decimal(18,4)")]
    assert tuples(out, "year") == [(2004,), (2011,)]
    assert silver.exports_from_long(raw(spark, EXPORTS).limit(0)).columns == ["year", "province", "country", "fob_usd"]


def test_exports_keep_all_landings_unless_told(spark):
    again = {k: v * 2 for k, v in EXPORTS.items()} | {"raw_value": ["1", "2", "3", "4"], "landing": ["a", "a", "b", "b"]}
    assert silver.exports_from_long(raw(spark, again)).count() == 4
    newest = silver.exports_from_long(raw(spark, again), landing="landing")
    assert tuples(newest, "country", "fob_usd") == [("chile", Decimal("3")), ("india", Decimal("4"))]


def test_certs_values(spark):
    out = silver.senasa_certs(raw(spark, CERTS).drop("seq"))
    assert out.schema.names == silver_table("senasa_certs").schema.names
    assert [t for _, t in out.dtypes] == [t.simpleString() for t in (f.dataType for f in silver_table("senasa_certs").schema)]
    assert tuples(out, "fecha", "provincia_id", "pais_destino_id", "tn", "year", "month") == [
        (date(2019, 11, 2), 26, 356, Decimal("73"), 2019, 11), (date(2021, 4, 30), 54, 152, Decimal("8.25"), 2021, 4),
    ]


@pytest.mark.parametrize("changes,kept", [
    ({"pais_destino": [None, "Chile"]}, ["Chile"]),
    ({"pais_destino": [" ", "Chile"]}, ["Chile"]),
    ({"pais_destino": [" India\t", "Chile"]}, ["Chile", "India"]),
    ({"fecha": ["2021-02-30", "2021-04-30"]}, ["Chile"]),
    ({"tn": ["-0.5", "2"]}, ["Chile"]),
    ({"tn": [None, "2"]}, ["Chile", "India"]),
    ({"tn": ["two", "2"]}, ["Chile", "India"]),
])
def test_certs_rules(spark, changes, kept):
    out = silver.senasa_certs(raw(spark, CERTS, **changes).drop("seq"))
    assert [r[0] for r in tuples(out, "pais_destino")] == kept


def test_certs_merge_equal_rows_after_the_cast(spark):
    twice = {k: [v[0], v[0]] for k, v in CERTS.items()} | {"tn": ["73", "73.00"], "oficina_cf": ["Posadas", " Posadas"]}
    assert silver.senasa_certs(raw(spark, twice).drop("seq")).count() == 1


@pytest.mark.parametrize("changes,left", [
    ({"value": ["-", "64"]}, "IND"), ({"value": ["0.000", "64"]}, "IND"),
    ({"value": ["-2", "64"]}, "IND"), ({"country_code": [None, "IND"]}, "IND"),
    ({"country_code": ["", "IND"]}, "IND"), ({"indicator_code": [None, "WOOL"]}, "IND"),
    ({"indicator_code": ["\t", "WOOL"]}, "IND"), ({"year": [str(INDICATOR_YEARS[0] - 1), "2016"]}, "IND"),
    ({"year": [str(INDICATOR_YEARS[1] + 1), "2016"]}, "IND"), ({"year": ["x", "2016.0"]}, "IND"),
])
def test_indicator_rules(spark, changes, left):
    assert tuples(silver.worldbank_indicators(raw(spark, INDICATORS, **changes), ["seq"]), "country_code") == [(left,)]


def test_indicators_keep_the_first(spark):
    data = {k: [v[0], v[0], v[1]] for k, v in INDICATORS.items()} | {"value": ["17.125", "18", "64"]}
    out = silver.worldbank_indicators(raw(spark, data), ["seq"])
    assert tuples(out, "country_code", "value") == [("CHL", Decimal("17.125")), ("IND", Decimal("64"))]
    assert dict(out.dtypes)["value"] == "decimal(18,6)" and dict(out.dtypes)["year"] == "int"


def test_readings(spark):
    out = silver.weather_daily_readings(raw(spark, READINGS), ["seq"])
    assert out.schema == silver_table("weather_daily_readings").schema
    assert tuples(out, "year", "month") == [(2022, 10), (2022, 8)]
    assert silver.weather_daily_readings(raw(spark, READINGS).limit(0), ["seq"]).schema.names == out.schema.names


@pytest.mark.parametrize("changes,kept", [
    ({"date": [None, "2022-10-11"]}, ["salta"]), ({"date": ["2022-13-01", "2022-10-11"]}, ["salta"]),
    ({"province": [None, "salta"]}, ["salta"]), ({"province": [" ", "salta"]}, [" ", "salta"]),
])
def test_readings_rules(spark, changes, kept):
    out = silver.weather_daily_readings(raw(spark, READINGS, **changes), ["seq"])
    assert [r[0] for r in tuples(out, "province")] == kept


def test_readings_keep_the_first_of_a_day(spark):
    data = {k: [v[0], v[0]] for k, v in READINGS.items()} | {
        "date": ["2022-08-09", "2022-08-09 07:30:00"], "temp_max_c": ["11.5", "40"],
    }
    assert tuples(silver.weather_daily_readings(raw(spark, data), ["seq"]), "temp_max_c") == [(Decimal("11.5"),)]


def test_refresh_reads_files_in_order_and_is_repeatable(spark, tmp_path):
    """The earlier landing wins although its file is the smaller one, with files and with a catalog table."""
    bronze, target = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    columns = RAW_COLUMNS["weather_daily_readings"]
    first = raw(spark, READINGS).select(*columns)
    later = first.withColumn("temp_max_c", F.lit("40"))
    for _ in range(5):
        later = later.union(later)
    landing.land(later.coalesce(1), bronze, "weather", date(2024, 2, 1))
    landing.land(first.coalesce(1), bronze, "weather", date(2024, 1, 1))
    for _ in range(2):
        stored = silver.refresh(spark, "weather_daily_readings", bronze, target)
        assert tuples(stored, "temp_max_c") == [(Decimal("11.5"),), (Decimal("26.25"),)]
    table = f"readings_{abs(hash(str(tmp_path)))}"
    for _ in range(2):
        silver.refresh(spark, "weather_daily_readings", bronze, f"{tmp_path}/table", table=table)
    assert tuples(spark.table(table), "temp_max_c") == [(Decimal("11.5"),), (Decimal("26.25"),)]
    assert spark.table(table).schema.names == silver_table("weather_daily_readings").schema.names


def test_columns_are_bound_by_header(spark, tmp_path):
    """A file whose columns stand in another order gives the same table; one that lacks a column is an error."""
    bronze, target = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    columns = RAW_COLUMNS["weather_daily_readings"]
    landing.write_csv(raw(spark, READINGS).select(*reversed(columns)), bronze)
    stored = silver.refresh(spark, "weather_daily_readings", bronze, target)
    assert tuples(stored, "temp_max_c", "temp_min_c") == [(Decimal("11.5"), Decimal("-2.5")), (Decimal("26.25"), Decimal("9"))]
    landing.write_csv(raw(spark, READINGS).select(*columns[:-1]), bronze, "append")
    with pytest.raises(ValueError, match=columns[-1]):
        silver.refresh(spark, "weather_daily_readings", bronze, target)
