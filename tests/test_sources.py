import json

import pytest
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.operators import profile, quality, scd
from siltline.sources import history, landing, payload, raw_csv, tables
from tests.conftest import tuples


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


# ---------------------------------------------------------------- CSV

def test_raw_read_is_text_only(spark, tmp_path):
    put(tmp_path / "source=x/year=2024/month=03/f.csv", "a,b\n1, 2 \n,3\n")
    df = raw_csv.read_raw_csv(spark, str(tmp_path))
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert tuples(df) == [("1", " 2 "), (None, "3")]


def test_positions_give_file_order(spark, tmp_path):
    put(tmp_path / "month=02/f.csv", "a\n" + "\n".join(f"late{i}" for i in range(2000)) + "\n")
    put(tmp_path / "month=01/f.csv", "a\nfirst\nsecond\n")
    df = raw_csv.read_raw_csv(spark, str(tmp_path), ["a"], position=True)
    assert [r.a for r in df.orderBy(*raw_csv.POSITION).limit(3).collect()] == ["first", "second", "late0"]


def test_drifting_headers(spark, tmp_path):
    put(tmp_path / "m=1/f.csv", "a,b\n1,2\n")
    put(tmp_path / "m=2/f.csv", "b,a\n4,3\n")
    put(tmp_path / "m=3/f.csv", "a,c\n5,6\n")
    put(tmp_path / "m 4/f.csv", "a,b\n7,8\n")
    assert tuples(raw_csv.read_drifting_csv(spark, str(tmp_path)), "a", "b", "c") == [
        ("1", "2", None), ("3", "4", None), ("5", None, "6"), ("7", "8", None)]


def test_no_file_is_left_out_or_read_by_another_header(spark, tmp_path):
    put(tmp_path / "m/f.csv", "a,b\n1,2\n")
    put(tmp_path / "m/g.CSV", "b,a\n4,3\n")
    put(tmp_path / "m/deep/download", "b,a\n6,5\n")
    put(tmp_path / "m/_hidden.csv", "z\n1\n")
    assert tuples(raw_csv.read_raw_csv(spark, str(tmp_path), ["a", "b"])) == [("1", "2"), ("3", "4"), ("5", "6")]
    with pytest.raises(ValueError, match="no column c"):
        raw_csv.read_raw_csv(spark, str(tmp_path), ["a", "c"])
    put(tmp_path / "n/f.csv", "a,a\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        raw_csv.read_raw_csv(spark, str(tmp_path / "n"))


# ---------------------------------------------------------------- landing

def test_landing_key(spark):
    key = spark.range(1).select(landing.landing_key("indec", date(2024, 3, 5), "f.csv")).first()[0]
    assert key == "source=indec/year=2024/month=03/f.csv"


def test_landing_folders_and_blanks(spark, frame, tmp_path):
    values = [(1, " x ", date(2024, 3, 1)), (2, "   ", date(2023, 11, 2)), (3, "", date(2023, 11, 2)), (4, None, date(2023, 11, 3))]
    rows = frame("i int, a string, d date", *values)
    landing.land(rows, str(tmp_path / "r"), "s", "d")
    assert {p.relative_to(tmp_path / "r").as_posix() for p in (tmp_path / "r").glob("*/*/*")} == {
        "source=s/year=2024/month=03", "source=s/year=2023/month=11"}
    assert tuples(raw_csv.read_raw_csv(spark, str(tmp_path / "r"))) == [("1", " x "), ("2", "   "), ("3", None), ("4", None)]
    landing.land(frame("a string, year string", ("1", "2020")), str(tmp_path / "q"), "s", date(2024, 3, 1))
    assert raw_csv.read_raw_csv(spark, str(tmp_path / "q")).columns == ["a", "year"]


def test_status(frame):
    candidates = frame("k string, n int, bad boolean", ("a", 1, False), ("b", 0, False), ("c", 1, False), ("d", 1, True), ("a2", 1, False))
    ledger = frame("k string", ("a",), ("a",), ("zz",))
    out = landing.with_status(candidates, ledger, "k", empty=F.col("n") == 0, failed=F.col("bad"))
    assert tuples(out, "k", "status") == [("a", "skipped"), ("a2", "uploaded"), ("b", "skipped"), ("c", "uploaded"), ("d", "error")]
    assert tuples(landing.status_counts(out)) == [("error", 1), ("skipped", 2), ("uploaded", 2)]
    assert tuples(landing.pending(candidates, ledger, "k"), "k") == [("a2",), ("b",), ("c",), ("d",)]


def test_landing_metadata(frame):
    out = landing.with_landing_metadata(frame("a int", (1,)), datetime(2024, 3, 1, 6), source_url="u", date_range="2010:2023")
    assert out.columns == ["a", "ingested_at", "source_url", "date_range"]
    assert out.first().ingested_at == datetime(2024, 3, 1, 6)


# ---------------------------------------------------------------- tables

def test_overwrite_replaces_only_touched_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(frame("v string, y int", ("a", 1), ("b", 2)), path, ["y"])
    for _ in range(2):
        tables.overwrite_partitions(frame("v string, y int", ("c", 2), ("d", 3)), path, ["y"])
    assert tuples(spark.read.parquet(path)) == [("a", 1), ("c", 2), ("d", 3)]


def test_read_or_empty(spark, tmp_path):
    schema = T.StructType.fromDDL("a int")
    assert tables.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0


# ---------------------------------------------------------------- payloads

def answer(*rows):
    """A two-part answer: paging facts, then the rows."""
    return json.dumps([{"page": 1}, list(rows)])


def test_flatten_records(frame):
    row = lambda year, value: {"country": {"value": "Kenya"}, "countryiso3code": "KEN", "date": year, "value": value, "indicator": {"id": "T"}}
    bodies = [answer(row("1999", 7.25), row("1998", None)), answer(), '{"message":1}', "<html>", "[{}]", "[{},null]", None]
    df = frame("n string, c string, body string", *[("name", f"C{i}", b) for i, b in enumerate(bodies)])
    assert tuples(payload.flatten_records(df, "body", "n", "c")) == [
        ("Kenya", "KEN", "name", "C0", "1998", None), ("Kenya", "KEN", "name", "C0", "1999", "7.25")]


def test_zip_columns(frame):
    series = {"time": ["2019-06-30", "2019-07-01"], "high": [4.5, 6.0], "rain": [None, 0.25]}
    bodies = [json.dumps({"daily": series}), json.dumps({"elevation": 9}), json.dumps({"daily": {"time": []}}), "<html>"]
    df = frame("province string, lat double, body string", *[(f"p{i}", 51.5, b) for i, b in enumerate(bodies)])
    fields = {"high": "temp_max_c", "rain": "rain", "wind": "wind"}
    assert tuples(payload.zip_columns(df, "body", fields, ["province", "lat"])) == [
        ("2019-06-30", "p0", 51.5, "4.5", None, None), ("2019-07-01", "p0", 51.5, "6.0", "0.25", None)]


def catalogue(*formats, success=True):
    return json.dumps({"success": success, "result": {"resources": [{"format": f, "url": f"ftp://files.test/set{i}/data_{f}#x", "name": f"n{i}"} for i, f in enumerate(formats)]}})


def test_pick_resource(frame):
    bodies = [catalogue("PDF", "csv", "CSV"), catalogue("PDF"), catalogue("CSV", success=False), catalogue(), "junk"]
    df = frame("id int, body string", *list(enumerate(bodies)))
    assert tuples(payload.pick_resource(df, "body", "d.csv")) == [
        (0, "ok", "ftp://files.test/set1/data_csv#x", "n1", "data_csv#x"), (1, "no_resource", None, None, None),
        (2, "api_error", None, None, None), (3, "no_resource", None, None, None), (4, "api_error", None, None, None)]


def test_file_name(frame):
    df = frame("u string", ("http://e.com/a/b.csv?x=/y",), ("?x",), ("",))
    assert [r[0] for r in df.select(payload.file_name_of("u", "default.csv")).collect()] == ["b.csv", "default.csv", "default.csv"]


def test_concat_sorted(frame):
    a, b = frame("i string, y int", ("b", 1), ("a", 2)), frame("i string, y int", ("a", 1))
    assert [tuple(r) for r in payload.concat_sorted([a, b, a.limit(0)], ["i", "y"]).collect()] == [("a", 1), ("a", 2), ("b", 1)]


def test_rolling_requests(frame):
    out = payload.rolling_requests(frame("p string", ("x",)), date(2024, 2, 29))
    assert tuples(out) == [("x", date(2023, 2, 28), date(2024, 2, 29))]


# ---------------------------------------------------------------- history store

def test_history_store(spark, frame, tmp_path):
    root, ddl = str(tmp_path / "h"), "id string, name string"
    runs = [(datetime(2024, 1, 1), [("a", "A"), ("b", "B")]), (datetime(2024, 2, 1), [("a", "A2"), ("c", "C")]), (datetime(2024, 2, 1), [("a", "A2"), ("c", "C")])]
    memory = None
    for ts, rows in runs[:2]:
        df = frame(ddl, *rows)
        memory = scd.initial(df, "id", ["name"], ts) if memory is None else scd.snapshot(memory, df, "id", ["name"], ts)
    for ts, rows in runs:
        history.advance(spark, root, frame(ddl, *rows), "id", ["name"], ts)
    assert tuples(history.read_history(spark, root)) == tuples(memory)
    assert tuples(history.read_current(spark, root), "id", "name") == [("a", "A2"), ("b", "B"), ("c", "C")]


# ---------------------------------------------------------------- profile

def test_profile(spark, tmp_path):
    put(tmp_path / "f.csv", "a,x,e,m\n1,,,1.5\n2,hello,,x\n3,world,,2\n4,,,7\n")
    df = raw_csv.read_raw_csv(spark, str(tmp_path), position=True)
    out = profile.profile(df, raw_csv.POSITION, infer_text=True).where(~F.col("column").startswith("_"))
    assert tuples(out, "column", "dtype", "rows", "null_pct", "sample") == [
        ("a", "bigint", 4, 0.0, "1"), ("e", "string", 4, 100.0, "—"), ("m", "string", 4, 0.0, "1.5"), ("x", "string", 4, 50.0, "hello")]
    assert [r.a for r in profile.head(df, raw_csv.POSITION).collect()] == ["1", "2", "3"]


def test_profile_of_an_empty_table(frame):
    assert tuples(profile.profile(frame("a int"), ["a"]), "column", "rows", "null_pct", "sample") == [("a", 0, None, "—")]


def test_table_cell_is_escaped_then_cut(frame):
    df = frame("s string", ("a|b",), ("x" * 79 + "|y",))
    assert tuples(df.select(profile.table_cell("s"))) == [("a\\|b",), ("x" * 79 + "\\",)]


# ---------------------------------------------------------------- quality

def test_quality(frame):
    child = frame("id int, p string, s string", (1, "a", "x"), (1, "z", "y"), (2, "z", None), (None, None, "q"))
    parent = frame("k string", ("a",), ("b",))
    assert tuples(quality.null_counts(child, ["id", "p"])) == [("id", 1), ("p", 1)]
    assert tuples(quality.duplicates(child, "id")) == [(1, 2)]
    assert tuples(quality.unaccepted(child, "s", ["x", "y"])) == [("q", 1)]
    assert tuples(quality.orphans(child, "p", parent, "k")) == [("z", 2)]
    suite = quality.Suite().add("c", "id", "not_null", "unique").add("c", "s", "accepted_values", values=["x"])
    suite.add("c", "p", "relationships", parent="p", parent_column="k").add("p", "k", "unique", "not_null")
    assert tuples(suite.run({"c": child, "p": parent})) == [
        ("c", "id", "not_null", 1, "fail"), ("c", "id", "unique", 1, "fail"), ("c", "p", "relationships", 2, "fail"),
        ("c", "s", "accepted_values", 2, "fail"), ("p", "k", "not_null", 0, "pass"), ("p", "k", "unique", 0, "pass")]


def test_table_overwrite_keeps_other_partitions(spark, frame, tmp_path):
    name, schema = f"t_{abs(hash(str(tmp_path)))}", T.StructType.fromDDL("v string, y int")
    tables.create_table(spark, name, schema, ["y"], str(tmp_path / "t"))
    tables.overwrite_table(frame("y int, v string", (1, "a"), (2, "b")), name, ["y"])
    tables.create_table(spark, name, schema, ["y"], str(tmp_path / "t"))
    tables.overwrite_table(frame("y int, v string", (2, "c")), name, ["y"])
    assert tuples(spark.table(name)) == [("a", 1), ("c", 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
