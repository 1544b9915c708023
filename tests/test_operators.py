from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from siltline.operators import allocate, analytics, dedup, joins, reshape, scd, star, validate
from tests.conftest import plan_of, tuples

# ---------------------------------------------------------------- reshape

MATRIX = (
    "indice_tiempo string, santa_fe_china string, santa_fe_total_santa_fe string, la_pampa_chile string, "
    "la_pampa_total_la_pampa string, la_china string, la_total_la string, mystery string, "
    "all_china string, all_total_general string"
)


def test_unpivot_takes_the_longest_prefix(frame):
    df = frame(MATRIX, ("2020-01-01", "1", "1", "2", "2", "3", "3", "4", "6", "6"))
    out = reshape.unpivot_matrix(df, ["indice_tiempo"])
    assert tuples(out, "province", "country", "raw_value") == [
        ("all", "china", "6"), ("la", "china", "3"), ("la_pampa", "chile", "2"), ("santa_fe", "china", "1"),
        ("unknown", "mystery", "4"),
    ]
    without = reshape.unpivot_matrix(df, ["indice_tiempo"], exclude_prefixes=["all"])
    assert ("all",) not in tuples(without, "province") and without.count() == 4


def test_unpivot_without_value_columns(frame):
    out = reshape.unpivot_matrix(frame("indice_tiempo string, a_total_a string", ("2020-01-01", "1")), ["indice_tiempo"])
    assert out.columns == ["indice_tiempo", "province", "country", "raw_value"] and out.count() == 0


def test_unpivot_reads_names_with_dots_and_quotes(frame):
    df = frame("id string, `a_b.c` string, `a_d'e` string, a_total_a string", ("1", "x", "y", "z"))
    assert tuples(reshape.unpivot_matrix(df, ["id"]), "province", "country", "raw_value") == [("a", "d'e", "y"), ("a", "b.c", "x")]


def test_split_by_prefix_table_against_brute_force(frame):
    names = ["santa_fe_china", "santa_cruz", "santa", "la_pampa_x_y", "la_x", "none_at_all", "a_", "_b", None, "santa_fe_"]
    prefixes = ["santa", "santa_fe", "la", "la_pampa", "a", ""]
    df = frame("name string", *[(n,) for n in names])
    out = reshape.split_by_prefix(df, "name", frame("p string", *[(p,) for p in prefixes]), "p")

    def cut(name):
        if name is None:
            return None, None, None
        fits = [p for p in prefixes if name.startswith(f"{p}_")]
        best = max(fits, key=len, default=None)
        return (name, "unknown", name) if best is None else (name, best, name[len(best) + 1 :])

    assert tuples(out) == sorted([cut(n) for n in names], key=repr)
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)


# ---------------------------------------------------------------- rules

RULES = [validate.required("a"), validate.positive("a"), validate.non_negative_or_null("b"), validate.in_range("a", 1, 9), validate.not_blank("t")]


def test_routing_keeps_every_row(frame):
    df = frame("a int, b int, t string", (1, 1, "x"), (None, 1, "x"), (0, -1, " "), (10, None, "x"), (5, None, None))
    valid, rejected = validate.route(df, RULES)
    assert valid.count() + rejected.count() == df.count()
    assert tuples(valid) == tuples(validate.keep_valid(df, RULES)) == [(1, 1, "x")]
    reasons = {tuple(r.reject_reasons) for r in rejected.collect()}
    assert ("a_missing", "a_not_positive", "a_out_of_range") in reasons
    assert ("a_not_positive", "b_negative", "a_out_of_range", "t_blank") in reasons
    counts = dict(tuples(validate.reject_counts(df, RULES)))
    assert counts == {"a_missing": 1, "a_not_positive": 2, "b_negative": 1, "a_out_of_range": 3, "t_blank": 2}


# ---------------------------------------------------------------- dedup

def test_first_and_latest(frame):
    df = frame("k string, o int, v string", ("a", 2, "late"), ("a", 1, "early"), ("b", 1, "only"), (None, 5, "n"))
    assert tuples(dedup.first_per_key(df, ["k"], ["o"]), "k", "v") == [("a", "early"), ("b", "only"), (None, "n")]
    assert ("a", "late") in tuples(dedup.latest_per_key(df, ["k"], ["o"]), "k", "v")
    with pytest.raises(ValueError):
        dedup.first_per_key(df, ["k"], [])


def test_survivors_are_cut_before_the_shuffle(spark):
    plan = plan_of(dedup.first_per_key(spark.range(1000).selectExpr("id % 3 as k", "id"), ["k"], ["id"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial") and "WindowGroupLimit" in plan


# ---------------------------------------------------------------- group joins

@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows, many of them copies of each other, have one key; the keys of others are NULL."""
    n = F.col("id")
    key = F.when(n < 3000, "hot").when(n < 3100, None).otherwise(F.concat(F.lit("k"), (n % 700).cast("string")))
    return spark.range(6000).select(key.alias("k"), (n % 2).cast("int").alias("part"), (n % 5).cast("int").alias("v"))


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
@pytest.mark.parametrize("null_safe", [True, False])
def test_group_join_equals_window(skewed, broadcast_rows, null_safe):
    totals = skewed.groupBy("k", "part").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    got = joins.group_join(skewed, totals, ["k", "part"], "n", null_safe, broadcast_rows, hot_share=50)
    expected = skewed.withColumn("total", F.sum("v").over(Window.partitionBy("k", "part")))
    if not null_safe:
        expected = expected.where("k is not null")
    assert tuples(got) == tuples(expected.select("k", "part", "v", "total"))


def test_hot_rows_are_not_shuffled(skewed):
    totals = skewed.groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    plan = plan_of(joins.group_join(skewed, totals, ["k"], "n", broadcast_rows=0, hot_share=50))
    assert "Union" in plan and "LeftAnti" in plan and "NestedLoop" not in plan
    assert "Exchange" not in plan[plan.index("BroadcastHashJoin") : plan.index("BroadcastExchange")]


def test_size_check(spark, frame):
    assert joins.fits_broadcast(frame("a string", ("x",)))
    assert not joins.fits_broadcast(spark.range(10), rows=9)
    assert not joins.fits_broadcast(frame("a string", ("x" * 100,)), size=50)


def test_share_and_apportion(frame):
    detail = frame(
        "y int, p string, c string, tn double",
        (1, "a", "x", 1.0), (1, "a", "z", 3.0), (1, "b", "x", 0.0), (2, "a", "x", 5.0), (2, None, "x", 5.0), (3, "a", "x", None),
    )
    shares = allocate.share_of_total(detail, ["y", "p"], "tn")
    assert tuples(shares, "y", "p", "c", "share") == [
        (1, "a", "x", 0.25), (1, "a", "z", 0.75), (1, "b", "x", None), (2, "a", "x", 1.0), (3, "a", "x", None),
    ]
    totals = frame("y int, p string, usd double", (1, "a", 60.0), (1, "a", 40.0), (1, "b", 7.0), (3, "a", 1.0), (9, "q", 5.0))
    out = allocate.apportion(detail, totals, ["y", "p"], "tn", "usd", "fob", "total")
    assert tuples(out, "y", "p", "c", "fob", "total") == [
        (1, "a", "x", 25.0, 100.0), (1, "a", "z", 75.0, 100.0), (1, "b", "x", None, 7.0), (2, "a", "x", 0.0, 0.0), (3, "a", "x", None, 1.0),
    ]
    assert tuples(allocate.unallocated(detail, totals, ["y", "p"], "usd")) == [(9, "q", 5.0)]


def test_apportioned_sum_is_the_allocated_total(spark):
    n = F.col("id")
    detail = spark.range(5000).select((n % 7).alias("y"), (n % 90).alias("p"), n.alias("c"), (n % 11).cast("double").alias("tn"))
    totals = spark.range(400).select((n % 7).alias("y"), (n % 120).alias("p"), (n * 1.5).alias("usd"))
    out = allocate.apportion(detail, totals, ["y", "p"], "tn", "usd", "fob", "total").agg(F.sum("fob")).first()[0]
    lost = allocate.unallocated(detail, totals, ["y", "p"], "usd").agg(F.sum("usd")).first()[0]
    assert out + lost == pytest.approx(totals.agg(F.sum("usd")).first()[0])


# ---------------------------------------------------------------- star

def test_date_dimension(spark):
    dim = star.date_dimension(star.date_spine(spark, date(1993, 1, 1), date(2031, 1, 1)))
    assert dim.count() == 13879
    assert tuples(dim.agg(F.min("date_key"), F.max("date_key"))) == [(date(1993, 1, 1), date(2030, 12, 31))]
    assert star.first_of_year(dim).count() == 38


def test_spine_of_an_empty_frame(frame):
    assert star.spine_of(frame("d date"), "d").count() == 0


def test_lookup(frame):
    fact = frame("c string, y int", ("x", 1), ("z", 2), (None, 3))
    dim = frame("name string, key string", ("x", "k1"), ("w", "k2"), (None, "k9"))
    out = star.lookup_keys(fact, [star.Lookup(dim, "c", "name", "key")])
    assert tuples(out) == [("x", 1, "k1"), ("z", 2, None), (None, 3, None)]


def test_lookup_with_repeated_names(frame):
    fact = frame("c string", ("x",))
    dim = frame("name string, key string", ("x", "k2"), ("x", "k1"))
    keyed = lambda mode: tuples(star.lookup_keys(fact, [star.Lookup(dim, "c", "name", "key", mode)]))
    assert keyed("fan_out") == [("x", "k1"), ("x", "k2")]
    assert keyed("first") == [("x", "k1")]
    with pytest.raises(PySparkException, match="not unique"):
        keyed("error")


# ---------------------------------------------------------------- history

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
DDL = "id string, name string, area string"


def test_snapshot(frame):
    first = scd.initial(frame(DDL, ("a", "A", "x"), ("b", "B", None), ("c", "C", "x"), (None, "N", "x")), "id", ["name", "area"], T1)
    assert first.count() == 3
    second = scd.snapshot(first, frame(DDL, ("a", "A", "x"), ("b", "B", "y"), ("d", "D", "x")), "id", ["name", "area"], T2)
    assert tuples(second, "id", "area", "valid_from", "valid_to") == sorted([
        ("a", "x", T1, None), ("b", None, T1, T2), ("b", "y", T2, None), ("c", "x", T1, None), ("d", "x", T2, None),
    ], key=repr)
    again = scd.snapshot(second, frame(DDL, ("a", "A", "x"), ("b", "B", "y"), ("d", "D", "x")), "id", ["name", "area"], T3)
    assert tuples(again) == tuples(second)
    assert tuples(scd.current_rows(second, "id"), "id", "area") == [("a", "x"), ("b", "y"), ("c", "x"), ("d", "x")]
    assert tuples(scd.as_of(second, datetime(2024, 1, 31)), "id", "area") == [("a", "x"), ("b", None), ("c", "x")]
    assert ("b", "y") in tuples(scd.as_of(second, T2), "id", "area")


def test_several_versions_of_a_key_give_one_row(frame):
    rows = frame(DDL, ("a", "B", "x"), ("a", "A", "y"), ("a", "A", "x"))
    assert tuples(scd.initial(rows, "id", ["name", "area"], T1), "id", "name", "area") == [("a", "A", "x")]


def test_current_rows_settle_ties(frame):
    history = frame("id string, name string, valid_from timestamp, valid_to timestamp, updated_at timestamp",
                    ("a", "A", T1, None, T1), ("a", "B", T1, None, T1), ("a", "C", T1, T2, T2))
    assert tuples(scd.current_rows(history, "id"), "name") == [("B",)]


# ---------------------------------------------------------------- analytics

def test_change_rank_and_correlation(frame):
    df = frame("k string, y int, v double", ("a", 1, 1.0), ("a", 2, 3.0), ("a", 3, 2.0), ("b", 1, 3.0))
    assert tuples(analytics.change_by_period(df, ["k"], "y", "v"), "k", "y", "change") == [
        ("a", 1, None), ("a", 2, 2.0), ("a", 3, -1.0), ("b", 1, None)]
    tied = frame("k string, v int", ("a", 9), ("a", 9), ("a", 5), ("a", 1))
    assert tuples(analytics.top_ranked(tied, ["k"], [F.col("v").desc()], 2), "v", "rank") == [(9, 1), (9, 1)]
    pairs = frame("k string, x double, y double", ("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0))
    assert tuples(analytics.correlation_by(pairs, ["k"], "x", "y"), "n") == [(3,)]
    assert analytics.correlation_by(pairs, ["k"], "x", "y").first().correlation == pytest.approx(1.0)


def test_suite_reads_each_table_once(spark):
    """Nulls, repeats, unknown values and missing parents, in one pass over each table; types of child and parent may differ."""
    from siltline.operators.quality import Suite
    from siltline.session import settle

    child = settle(spark.createDataFrame([(1, "x", "1", 0.0), (1, None, "2", -0.0), (None, "y", "03", 1.5), (2, "z", "nine", None), (3, "z", None, 2.5)],
                                         "id int, kind string, `the.parent` string, amount double"))
    parent = settle(spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "key long"))
    checks = (
        Suite().add("child", "id", "not_null", "unique").add("child", "kind", "not_null").add("child", "amount", "unique")
        .add("child", "kind", "accepted_values", values=("x", "y")).add("child", "the.parent", "relationships", parent="parent", parent_column="key")
        .add("parent", "key", "unique", "not_null").add("child", "id", "relationships", parent="parent", parent_column="key"))
    df = checks.run({"child": child, "parent": parent})
    got = {(r.table_name, r.column, r.test): (r.failures, r.status) for r in df.collect()}
    assert got == {
        ("child", "id", "not_null"): (1, "fail"), ("child", "id", "unique"): (1, "fail"), ("child", "kind", "not_null"): (1, "fail"),
        ("child", "amount", "unique"): (1, "fail"), ("child", "kind", "accepted_values"): (1, "fail"), ("child", "the.parent", "relationships"): (1, "fail"),
        ("parent", "key", "unique"): (1, "fail"), ("parent", "key", "not_null"): (1, "fail"), ("child", "id", "relationships"): (0, "pass")}
    plan = plan_of(df)
    assert plan.split("== Initial Plan ==")[0].count("Scan parquet") == 2 and "NestedLoop" not in plan and "Cartesian" not in plan
    empty = checks.run({"child": child.limit(0), "parent": parent.limit(0)})
    assert {(r.failures, r.status) for r in empty.collect()} == {(0, "pass")}
    with pytest.raises(ValueError, match="unknown test"):
        Suite().add("child", "id", "positive").run({"child": child})
