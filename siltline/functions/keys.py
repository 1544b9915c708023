"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-in for NULL and separator of the widely used dbt surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: str | Column, null_token: str = NULL_TOKEN) -> Column:
    """md5 over the text of the columns. Pass integers, dates and strings; doubles have no stable text."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_token)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
