from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltline.functions import casts, dates, keys, labels, numbers, text
from tests.conftest import tuples


@pytest.mark.parametrize("raw,value", [
    ("2023-03-15", date(2023, 3, 15)), ("not_a_date", None), (None, None), ("", None), ("2023-02-30", None),
])
def test_date(frame, raw, value):
    assert tuples(frame("x string", (raw,)).select(casts.to_date_or_null("x"))) == [(value,)]


def test_date_with_format(frame):
    df = frame("x string", ("15/03/2023",), ("2023-03-15",))
    assert tuples(df.select(casts.to_date_or_null("x", "dd/MM/yyyy"))) == [(None,), (date(2023, 3, 15),)]


@pytest.mark.parametrize("raw,value", [
    ("1500.50", "1500.5"), ("1e3", "1000"), (" 5 ", "5"), ("inf", None), ("not_a_number", None),
    ("123456789012345678", None), ("0.00004", "0"), ("-10.0", "-10"),
])
def test_decimal(frame, raw, value):
    got = frame("x string", (raw,)).select(casts.to_decimal_or_null("x", 18, 4)).first()[0]
    assert got == (None if value is None else Decimal(value))


@pytest.mark.parametrize("raw,value", [
    ("14", 14), ("14.0", 14), ("14.7", 14), ("-3.9", -3), ("NaN", None), ("99999999999", None), ("x", None), (None, None),
])
def test_int(frame, raw, value):
    assert frame("x string", (raw,)).select(casts.to_int_or_null("x")).first()[0] == value


def test_strip_takes_all_whitespace(frame):
    df = frame("x string", ("\t a b \r\n",), ("   ",), (None,))
    assert tuples(df.select(text.strip("x"))) == [("",), ("a b",), (None,)]
    assert tuples(df.select(text.is_blank("x"))) == [(False,), (True,), (True,)]


def test_canonical_key_joins_spellings(frame):
    aliases = {"pba": "buenos aires", "espania": "espana"}
    df = frame("x string", ("PBA",), ("buenos_aires",), ("  Buenos   Aires ",), ("ESPAÑA",), ("espania",), ("Córdoba",))
    got = {r[0] for r in df.select(text.canonical_key("x", aliases)).collect()}
    assert got == {"buenos aires", "espana", "cordoba"}


def test_surrogate_key_tells_null_from_text(frame):
    df = frame("a int, b string", (1, None), (1, ""), (1, "<null>"), (None, "1"))
    assert df.select(keys.surrogate_key("a", "b").alias("k")).distinct().count() == 4
    assert df.select(F.length(keys.surrogate_key("a"))).first()[0] == 32


def test_ratio_and_default(frame):
    df = frame("a double, b double", (6.0, 3.0), (1.0, 0.0), (1.0, None))
    assert tuples(df.select(numbers.ratio("a", "b"))) == [(2.0,), (None,), (None,)]
    assert tuples(df.select(numbers.or_default("b", 9.0))) == [(0.0,), (3.0,), (9.0,)]


def test_calendar_columns(frame):
    df = frame("d date", (date(2024, 1, 1),), (date(2021, 1, 3),))
    got = tuples(df.select(*[c.alias(n) for n, c in dates.calendar_columns("d").items()]))
    assert got == [(2021, 1, 1, 53, "2021-Q1"), (2024, 1, 1, 1, "2024-Q1")]


def test_labels(frame):
    df = frame("x string", ("soja",), ("grano de soja",), ("lana",), (None,))
    groups = {"Oilseeds": ["soja", "girasol"], "Livestock": ["lana"]}
    assert tuples(df.select("x", labels.label_of("x", groups, "Other"))) == [
        ("grano de soja", "Other"), ("lana", "Livestock"), ("soja", "Oilseeds"), (None, "Other"),
    ]
    assert ("grano de soja", "Oilseeds") in tuples(df.select("x", labels.label_by_keyword("x", groups, "Other")))
    assert ("lana", "Wool") in tuples(df.select("x", labels.renamed_value("x", {"lana": "Wool"})))
    mapping = frame("v string, l string", ("soja", "S"))
    assert tuples(labels.label_from_table(df, "x", mapping, "v", "l", "out", "-"), "out") == [("-",), ("-",), ("-",), ("S",)]
