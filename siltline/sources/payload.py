"""JSON payloads to rows. A payload that is malformed or empty gives no rows and never fails the job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORDS = "array<struct<country: struct<value: string>, countryiso3code: string, date: string, value: string>>"
CATALOGUE = "success boolean, result struct<resources: array<struct<format: string, url: string, name: string>>>"


def flatten_records(df: DataFrame, body: str, indicator: str, indicator_code: str) -> DataFrame:
    """``[meta, [record, ...]]`` to one row per record, with the indicator the payload was asked for."""
    records = F.from_json(F.get_json_object(body, "$[1]"), RECORDS)
    rows = df.select(F.col(indicator).alias("indicator"), F.col(indicator_code).alias("indicator_code"), F.explode(records).alias("r"))
    return rows.select(
        F.col("r.country.value").alias("country"),
        F.col("r.countryiso3code").alias("country_code"),
        "indicator",
        "indicator_code",
        F.col("r.date").alias("year"),
        F.col("r.value").alias("value"),
    )


def zip_columns(
    df: DataFrame,
    body: str,
    fields: Mapping[str, str],
    constants: Sequence[str],
    block: str = "daily",
    time: str = "time",
    out_time: str = "date",
) -> DataFrame:
    """``{block: {time: [...], a: [...], ...}}`` to one row per time, with the constants of the payload.

    ``fields`` maps array names to output columns. An array that is absent gives NULLs.
    """
    names = [time, *fields]
    schema = f"`{block}` struct<{', '.join(f'`{n}`: array<string>' for n in names)}>"
    parsed = df.select(*constants, F.from_json(body, schema)[block].alias("b"))
    present = parsed.where(F.size(F.col("b")[time]) > 0)
    nothing = F.array().cast("array<string>")
    arrays = [F.coalesce(F.col("b")[n], nothing).alias(f"c{i}") for i, n in enumerate(names)]
    rows = present.select(*constants, *arrays)
    rows = rows.select(*constants, F.inline(F.arrays_zip(*[f"c{i}" for i in range(len(names))])))
    outputs = [F.col("c0").alias(out_time), *constants, *[F.col(f"c{i + 1}").alias(o) for i, o in enumerate(fields.values())]]
    return rows.where(F.col("c0").isNotNull()).select(*outputs)


def file_name_of(url: str | Column, default: str) -> Column:
    """Last path segment of a URL without its query, or the default."""
    u = F.col(url) if isinstance(url, str) else url
    path = F.split_part(u, F.lit("?"), F.lit(1))
    return F.coalesce(F.nullif(F.regexp_extract(path, "([^/]+)/*$", 1), F.lit("")), F.lit(default))


def pick_resource(df: DataFrame, body: str, default_name: str, wanted: str = "CSV") -> DataFrame:
    """The first resource of the wanted format in a catalogue payload, with a status instead of a failure."""
    parsed = df.withColumn("_c", F.from_json(body, CATALOGUE))
    matching = F.filter("_c.result.resources", lambda r: F.upper(r["format"]) == wanted)
    chosen = parsed.withColumn("_r", F.try_element_at(matching, F.lit(1)))
    ok = F.coalesce(F.col("_c.success"), F.lit(False))
    status = F.when(~ok, "api_error").when(F.col("_r").isNull(), "no_resource").otherwise("ok")
    found = status == "ok"
    return chosen.select(
        *[c for c in df.columns if c != body],
        status.alias("status"),
        F.when(found, F.col("_r.url")).alias("url"),
        F.when(found, F.col("_r.name")).alias("resource_name"),
        F.when(found, file_name_of(F.col("_r.url"), default_name)).alias("file_name"),
    )


def concat_sorted(frames: Sequence[DataFrame], order_by: Sequence[str]) -> DataFrame:
    """All frames one below the other, in a stated order; empty frames add nothing. The other columns break ties, so
    the order is total and many rows of one ``order_by`` value are spread over the range partitions."""
    whole = reduce(lambda a, b: a.unionByName(b), frames)
    return whole.orderBy(*order_by, *(c for c in whole.columns if c not in order_by))


def rolling_requests(stations: DataFrame, end: date | Column, months: int = 12) -> DataFrame:
    """One request per station for the months before ``end``; 29 February falls back to the 28th."""
    last = end if isinstance(end, Column) else F.lit(end)
    return stations.withColumns({"start_date": F.add_months(last, -months), "end_date": last})
