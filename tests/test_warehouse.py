"""Raw files to checked star schema, through the job entry points."""

import json
from datetime import date, datetime

from siltline.__main__ import main
from siltline.plans import bronze
from siltline.sources import landing
from siltline.sources.schemas import RAW_COLUMNS
from tests.conftest import tuples


def weather_body(*days):
    daily = {"time": list(days)}
    for i, name in enumerate(["temperature_2m_max", "temperature_2m_min", "precipitation_sum", "wind_speed_10m_max", "et0_fao_evapotranspiration"]):
        daily[name] = [i + 0.5] * len(days)
    return json.dumps({"daily": daily})


def indicator_body(*years):
    record = lambda y: {"country": {"value": "Argentina"}, "countryiso3code": "ARG", "date": y, "value": 7}
    return json.dumps([{}, [record(y) for y in years]])


def test_requests(spark, frame):
    ledger = frame("landing_key string", ("source=weather/year=2024/month=03/weather_salta.csv",))
    todo = bronze.weather_requests(spark, date(2024, 3, 1), ledger)
    assert todo.count() == 6 and "salta" not in {r.province for r in todo.collect()}
    assert tuples(todo.select("start_date", "end_date").distinct()) == [(date(2023, 3, 1), date(2024, 3, 1))]
    assert bronze.indicator_requests(spark).count() == 5


def test_file_resource(frame):
    body = json.dumps({"success": True, "result": {"resources": [{"format": "CSV", "url": "http://e.com/x.csv?a=1", "name": "n"}]}})
    out = bronze.file_resource(frame("body string", (body,), ("{}",)), "indec", date(2024, 3, 1), "d.csv")
    assert tuples(out, "status", "landing_key") == [("api_error", None), ("ok", "source=indec/year=2024/month=03/x.csv")]


def test_payload_files_are_landed_once(spark, frame, tmp_path, capsys):
    """The jobs from payload files to raw rows, and the list of what is still to be requested."""
    payloads, raw, ledger, silver = (f"{tmp_path}/{x}" for x in ("payloads", "bronze", "ledger", "silver"))
    rows = [("salta", -24.8, -65.4, weather_body("2024-01-01", "2024-01-02")), ("cordoba", -31.4, -64.2, "{broken"), ("la_pampa", -36.6, -64.3, json.dumps({"daily": {}}))]
    frame("province string, latitude double, longitude double, body string", *rows).write.json(payloads)
    once = ["bronze", "weather", "--payloads", payloads, "--bronze", raw, "--ledger", ledger, "--day", "2024-03-01", "--ingested-at", "2024-03-01T06:00:00"]
    assert [main(once), main(once)] == [0, 0] and capsys.readouterr().out.split() == ["uploaded", "skipped"]
    assert main(["silver", "weather_daily_readings", "--bronze", raw, "--target", f"{silver}/weather"]) == 0
    assert tuples(spark.read.parquet(f"{silver}/weather"), "province", "date") == [("salta", date(2024, 1, 1)), ("salta", date(2024, 1, 2))]
    landing.land_once(frame("a string", ("1",)), raw, "weather", date(2024, 3, 1), "weather_salta.csv", ledger, datetime(2024, 3, 1))
    assert main(["requests", "--end", "2024-03-01", "--target", f"{tmp_path}/todo", "--ledger", ledger]) == 0
    assert spark.read.json(f"{tmp_path}/todo").count() == 6
    assert main(["requests", "--end", "2024-03-01", "--target", f"{tmp_path}/todo"]) == 0
    assert spark.read.json(f"{tmp_path}/todo").count() == 7
    assert main(["profile", "--bronze", f"{raw}/source=weather", "--target", f"{tmp_path}/profile"]) == 0
    assert spark.read.parquet(f"{tmp_path}/profile").count() >= len(RAW_COLUMNS["weather_daily_readings"]) + 1


def test_whole_run(spark, frame, tmp_path, capsys):
    raw, silver, gold, day = f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold", date(2024, 3, 1)
    weather = bronze.weather_rows(frame("province string, latitude double, longitude double, body string", ("salta", -24.8, -65.4, weather_body("2024-01-01", "2024-01-02"))))
    assert weather.columns == RAW_COLUMNS["weather_daily_readings"]
    landing.land(weather, raw, "weather", day)
    payloads = frame("indicator string, indicator_code string, body string", ("agri_land_pct", "AG.LND.AGRI.ZS", indicator_body("2021", "2020")))
    landing.land(bronze.indicator_rows(payloads), raw, "worldbank", day)
    certs = ", ".join(f"{c} string" for c in RAW_COLUMNS["senasa_certs"])
    landing.land(frame(certs,
        ("2020-03-01", "o", "Salta", "1.0", "Chile", "2.0", "CHL", "América", "Soja", "CAMION", "10"),
        ("2020-03-02", "o", "Salta", "1.0", "Chile", "2.0", "CHL", "América", "Trigo", "CAMION", "30"),
    ), raw, "senasa", day)
    landing.land(frame("indice_tiempo string, salta_chile string, salta_total_salta string", ("2020-01-01", "400", "400")), raw, "indec", day)
    for name, source in {"indec_exports": "indec", "senasa_certs": "senasa", "worldbank_indicators": "worldbank", "weather_daily_readings": "weather"}.items():
        assert main(["silver", name, "--bronze", f"{raw}/source={source}", "--target", f"{silver}/{name}"]) == 0
    for _ in range(2):
        assert main(["gold", "--silver", silver, "--gold", gold, "--run-ts", "2024-03-01T00:00:00"]) == 0
    assert tuples(spark.read.parquet(f"{gold}/fct_exports"), "year", "total_tn", "fob_usd", "total_fob_usd") == [(2020, 10.0, 100.0, 400.0), (2020, 30.0, 300.0, 400.0)]
    assert spark.read.parquet(f"{gold}/dim_date").count() == 13879
    assert main(["check", "--silver", silver, "--gold", gold]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 60 and all(line.startswith("pass") for line in lines)
