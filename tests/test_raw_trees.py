"""Raw trees: what is read of them, line breaks, profiles of many files, and landings that take values back."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltline.plans import silver
from siltline.session import workspace
from siltline.sources import landing
from siltline.sources.raw_csv import file_headers, headers, read_raw_csv
from siltline.sources.tree_profile import profile_files
from tests.conftest import tuples


def bytes_read(spark):
    """Of the local file system, in the process that holds driver and tasks."""
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem
    return sum(s.getBytesRead() for s in fs.getAllStatistics())


@pytest.fixture
def tree(spark):
    """Two files of 4 MB each, of different headers."""
    root = workspace(spark, "test-tree")
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("a"), F.repeat(F.lit("x"), 100).alias("b"))
    landing.write_csv(rows.coalesce(1), f"{root}/one")
    landing.write_csv(rows.select("b", "a").coalesce(1), f"{root}/two")
    return root


def test_a_tree_is_read_once(spark, tree):
    size = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(tree).agg(F.sum("length")).first()[0]
    start = bytes_read(spark)
    found = headers(spark, tree)
    assert set(found) == {("a", "b"), ("b", "a")} and bytes_read(spark) - start < size / 20
    start = bytes_read(spark)
    assert read_raw_csv(spark, tree, ["a", "b"]).agg(F.sum(F.col("a").cast("long") + F.length("b"))).first()[0] == 2 * sum(i + 100 for i in range(40_000))
    assert size <= bytes_read(spark) - start < 1.2 * size


def test_profile_of_a_tree_is_one_scan(spark, tree):
    start = bytes_read(spark)
    rows = {(r.file.split("/")[-2], r.column): r for r in profile_files(spark, tree).collect()}
    assert bytes_read(spark) - start < 1.3 * 2 * 4_400_000
    assert {k: (r.position, r.dtype, r.rows, r.columns, r.null_pct) for k, r in rows.items()} == {
        ("one", "a"): (1, "bigint", 40_000, 2, 0.0), ("one", "b"): (2, "string", 40_000, 2, 0.0),
        ("two", "b"): (1, "string", 40_000, 2, 0.0), ("two", "a"): (2, "bigint", 40_000, 2, 0.0)}
    assert rows["two", "a"].sample == "0"


def write(spark, path, text):
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(path))
    out.write(bytearray(text.encode()))
    out.close()


def test_profile_of_odd_files(spark):
    root = workspace(spark, "test-odd")
    write(spark, f"{root}/a b/ñ.csv", "x,y.z,w\n1,,\n2,q,\n,\"a,\"\"b\",1.5\n")
    write(spark, f"{root}/only header.csv", "h\n")
    write(spark, f"{root}/empty.csv", "")
    write(spark, f"{root}/bom", "﻿k,l\n-1,1e3\n")
    got = {(r.file.rsplit("/", 1)[1], r.column): (r.position, r.dtype, r.rows, r.null_pct, r.sample) for r in profile_files(spark, root).collect()}
    assert got == {
        ("ñ.csv", "x"): (1, "bigint", 3, 33.3, "1"), ("ñ.csv", "y.z"): (2, "string", 3, 33.3, "q"), ("ñ.csv", "w"): (3, "double", 3, 66.7, "1.5"),
        ("only%20header.csv", "h"): (1, "string", 0, None, "—"), ("bom", "k"): (1, "bigint", 1, 0.0, "-1"), ("bom", "l"): (2, "double", 1, 0.0, "1e3")}
    assert [names for _, names in file_headers(spark, root)] == [("x", "y.z", "w"), ("k", "l"), ("h",)]
    write(spark, f"{root}/twice", "n,n\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        profile_files(spark, root)


def test_profile_of_an_empty_tree(spark):
    root = workspace(spark, "test-none")
    write(spark, f"{root}/empty.csv", "")
    assert profile_files(spark, root).count() == 0


def test_line_breaks(spark):
    root = workspace(spark, "test-breaks")
    rows = [("1", 'two\nlines, "quoted"\n\nend'), ("2", "\n"), ("3", "plain"), ("4", None)]
    df = spark.createDataFrame(rows, "id string, `the note` string")
    with pytest.raises(PySparkException, match="line break in a value of column the note"):
        landing.land(df, root, "s", date(2024, 1, 1))
    landing.land(df, root, "s", date(2024, 1, 1), mode="overwrite", line_breaks=landing.QUOTE)
    assert tuples(read_raw_csv(spark, root, ["id", "the note"], multi_line=True)) == sorted(rows, key=repr)
    landing.land(df.where("id = '3'"), root, "s", date(2024, 1, 1), mode="overwrite")
    assert tuples(read_raw_csv(spark, root, ["the note"])) == [("plain",)]
    with pytest.raises(ValueError, match="line_breaks"):
        landing.write_csv(df, root, line_breaks="drop")


MATRIX = "indice_tiempo string, pba_total_pba string, pba_brasil string, pba_chile string, salta_total_salta string, salta_brasil string"


def land_matrix(spark, root, month, *rows):
    landing.land(spark.createDataFrame(rows, MATRIX).coalesce(1), root, "indec", date(2024, month, 1), mode="overwrite")


@pytest.mark.parametrize("whole_years", [False, True])
def test_newest_landing_is_chosen_before_the_rules(spark, whole_years):
    bronze, target = (workspace(spark, f"test-{x}") for x in ("bronze", "silver"))
    run = lambda: sorted(tuple(r) for r in silver.refresh(
        spark, "indec_exports", bronze, target, newest_landing=True, whole_years=whole_years).select("year", "province", "country", F.col("fob_usd").cast("int")).collect())
    land_matrix(spark, bronze, 1, ("2001-01-01", "9", "5", "6", "9", "7"), ("2002-01-01", "9", "1", "2", "9", "3"), ("2003-01-01", "9", "8", None, "9", None))
    assert run() == [(2001, "pba", "brasil", 5), (2001, "pba", "chile", 6), (2001, "salta", "brasil", 7), (2002, "pba", "brasil", 1), (2002, "pba", "chile", 2),
                     (2002, "salta", "brasil", 3), (2003, "pba", "brasil", 8)]
    # 5 becomes 0, 6 unreadable, 7 stays away or is blank; all of 2003 is zero; a cell that comes twice in a landing counts once, by its later row
    land_matrix(spark, bronze, 2, ("2001-01-01", "9", "0", "?", "9", " "), ("2003-01-01", "9", "0", "0", "9", "0"), ("2002-01-01", "9", "4", "4", "9", "4"), ("2002-06-01", "9", "40", "2", "9", "0"))
    for _ in range(2):
        assert run() == [(2002, "pba", "brasil", 40), (2002, "pba", "chile", 2)]
    assert {r[0] for r in spark.read.parquet(target).select("year").distinct().collect()} == {2002}


def test_whole_years_drop_cells_that_the_newest_landing_lacks(spark):
    raw = [("2001-01-01", "a", "x", "1", "01"), ("2001-01-01", "a", "y", "2", "01"), ("2001-01-01", "a", "x", "3", "02"), ("2002-01-01", "a", "y", "4", "01"), (None, "a", "y", "4", "02")]
    long = spark.createDataFrame(raw, "indice_tiempo string, province string, country string, raw_value string, landing string")
    cells = lambda **o: sorted((r.year, r.country, int(r.fob_usd)) for r in silver.exports_from_long(long, "landing", **o).collect())
    assert cells() == [(2001, "x", 3), (2001, "y", 2), (2002, "y", 4)]
    assert cells(whole_years=True) == [(2001, "x", 3), (2002, "y", 4)]


def test_emptied_partition_of_a_catalog_table(spark):
    name, bronze, target = "siltline_emptied", workspace(spark, "test-bronze"), workspace(spark, "test-table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    land_matrix(spark, bronze, 1, ("2001-01-01", "9", "5", "6", "9", "7"), ("2002-01-01", "9", "1", "2", "9", "3"))
    assert silver.refresh(spark, "indec_exports", bronze, target, table=name, newest_landing=True).count() == 6
    land_matrix(spark, bronze, 2, ("2001-01-01", "9", "0", "0", "9", "0"))
    assert {r.year for r in silver.refresh(spark, "indec_exports", bronze, target, table=name, newest_landing=True).collect()} == {2002}
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError, match="no cells"):
        silver.refresh(spark, "senasa_certs", bronze, target, newest_landing=True)
