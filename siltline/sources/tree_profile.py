"""Profile of a tree of raw files whose headers differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.operators.profile import NO_SAMPLE
from siltline.sources.raw_csv import BLOCK, FILE, ROW, file_headers, with_position


def profile_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, column, position, dtype, rows, columns, null_pct, sample): a row for each column of each file below ``path``.

    All files are read by one scan, by place and not by name, so files with any number of different headers are one job;
    each file brings its names as data. ``dtype`` is bigint or double where all values of a column parse as that, else
    string; ``sample`` is the first value in the order of the file, or a dash. A file of a header alone has no rows and
    a ``null_pct`` of null; files without a line are left out. Figures are added up in the map tasks, a row for each file
    that a task reads, so a file of any size is read by many tasks.
    """
    listed = file_headers(spark, path)
    width = max((len(names) for _, names in listed), default=0)
    known = spark.createDataFrame([(f, list(names)) for f, names in listed], f"`{FILE}` string, names array<string>")
    places = [f"c{i}" for i in range(width)]
    text = T.StructType([T.StructField(c, T.StringType()) for c in places or ["c0"]])
    if listed:
        reader = spark.read.option("header", True).option("enforceSchema", True).option("recursiveFileLookup", True).schema(text)
        scan = with_position(reader.csv(path if isinstance(path, str) else list(path)))
    else:
        scan = spark.createDataFrame([], T.StructType([*text.fields, T.StructField(FILE, T.StringType()), T.StructField(BLOCK, T.LongType()), T.StructField(ROW, T.LongType())]))
    order, measures = F.struct(BLOCK, ROW), [F.count("*").alias("rows")]
    for c in places:
        value = F.col(c)
        measures += [
            F.count(value).alias(f"n_{c}"), F.min_by(value, F.when(value.isNotNull(), order)).alias(f"s_{c}"),
            F.count(value.try_cast("bigint")).alias(f"b_{c}"), F.count(value.try_cast("double")).alias(f"d_{c}"),
        ]
    one_slash = F.regexp_replace(FILE, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")  # a listing and a scan write the scheme differently
    known, by_file = known.withColumn("_path", one_slash), scan.groupBy(FILE).agg(*measures).withColumn("_path", one_slash).drop(FILE)
    found = known.join(by_file, "_path", "left")
    rows, lines = F.coalesce("rows", F.lit(0)), []
    for i, c in enumerate(places):
        filled = F.coalesce(f"n_{c}", F.lit(0))
        kind = F.when(filled == 0, "string").when(filled == F.col(f"b_{c}"), "bigint").when(filled == F.col(f"d_{c}"), "double").otherwise("string")
        lines.append(F.struct(
            F.get("names", F.lit(i)).alias("column"), F.lit(i + 1).alias("position"), kind.alias("dtype"), rows.alias("rows"), F.size("names").alias("columns"),
            F.when(rows > 0, F.round((rows - filled) * 100.0 / rows, 1)).alias("null_pct"), F.coalesce(f"s_{c}", F.lit(NO_SAMPLE)).alias("sample")))
    empty = "array<struct<column:string,position:int,dtype:string,rows:bigint,columns:int,null_pct:double,sample:string>>"
    cells = F.array(*lines) if lines else F.lit(None).cast(empty)
    return found.select(F.col(FILE).alias("file"), F.inline(cells)).where("position <= columns")
