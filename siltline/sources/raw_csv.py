"""Raw CSV trees, every column a string, matched by the header of each file."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, BLOCK, ROW = "_file", "_block", "_row"
POSITION = [FILE, BLOCK, ROW]


#: Files whose first line is read at a time.
READERS = 16


def _first_line(spark: SparkSession, conf, uri: str, multi_line: bool) -> str | None:
    """The header line of a file, through its Hadoop file system: a buffer of bytes is read, whatever the size of the file."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        header = lines.readLine()
        while multi_line and header is not None and header.count('"') % 2 and (more := lines.readLine()) is not None:
            header += "\n" + more
        return None if header is None else header.removeprefix("\ufeff")
    finally:
        stream.close()


def file_headers(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> list[tuple[str, tuple[str, ...]]]:
    """The files below ``path`` (as ``_metadata.file_path`` has them) and the column names of each, in the order of the files.

    Spark lists them; of each only the first line is read, by a few threads of the driver, which holds the list of files
    for a scan anyway. Files without a line are left out."""
    paths = [path] if isinstance(path, str) else list(path)
    files = sorted(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).inputFiles())
    conf = spark._jsc.hadoopConfiguration()
    with ThreadPoolExecutor(READERS) as pool:
        found = list(pool.map(lambda f: _first_line(spark, conf, f, multi_line), files))
    out = []
    for f, header in zip(files, found, strict=True):
        if header is None:
            continue
        names = tuple(next(csv.reader(header.splitlines(True)), []))
        if len(set(names)) < len(names):
            raise ValueError(f"a header names a column twice: {header!r} in {f}")
        out.append((f, names))
    return out


def headers(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their header."""
    uri, hadoop = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path
    out: dict[tuple[str, ...], list[str]] = {}
    for f, names in file_headers(spark, path, multi_line):
        out.setdefault(names, []).append(hadoop(uri(f)).toString())
    return out


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    position: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """All files below ``path``, uncast, columns bound by name through the header of each file. Directory names are not
    turned into columns, and a field without text is NULL.

    With ``columns`` these are returned, and a file that lacks one of them is an error; without, all columns of all
    files are, NULL where a file has none. There is one scan for each distinct header, and a file whose header is not
    the one it was listed with fails. ``position`` adds the columns that say where a row stood: file, block and a
    number that grows within the block. Ordered by the three, rows come as they are in the files.

    A line is a row. With ``multi_line`` a quoted value may hold line breaks (``\\n``); a file is then read by one task.
    """
    groups = headers(spark, path, multi_line)
    if not groups:
        if columns is None:
            raise ValueError(f"no file with a header below {path}")
        kinds = [*((c, T.StringType()) for c in columns), *(zip(POSITION, (T.StringType(), T.LongType(), T.LongType()), strict=True) if position else ())]
        return spark.createDataFrame([], T.StructType([T.StructField(c, k) for c, k in kinds]))
    frames = []
    for names, files in groups.items():
        if lacking := [c for c in columns or () if c not in names]:
            raise ValueError(f"no column {', '.join(lacking)} in {files[0]}")
        reader = spark.read.option("header", True).option("enforceSchema", False)
        if multi_line:
            reader = reader.option("multiLine", True).option("lineSep", "\n")
        scan = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(files)
        kept = [f"`{c}`" for c in columns or names]
        frames.append(with_position(scan).select(*kept, *POSITION) if position else scan.select(*kept))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_position(scan: DataFrame) -> DataFrame:
    """Position columns; has to be applied to the scan itself, before any other operator."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    )


def read_drifting_csv(spark: SparkSession, root: str, position: bool = False) -> DataFrame:
    """A tree whose files have different headers, matched by column name; columns that a file lacks are NULL."""
    return read_raw_csv(spark, root, position=position)
