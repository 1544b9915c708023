"""Trimming and key normalisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\f\r"

# Accented letters and their plain forms, position by position.
ACCENTED = "áàâäãéèêëíìîïóòôöõúùûüñç"
PLAIN = "aaaaaeeeeiiiiooooouuuunc"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Trim every kind of ASCII whitespace; plain ``trim`` removes blanks only."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def strip_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: strip(c) for c in columns})


def is_blank(c: str | Column) -> Column:
    """True for NULL and for whitespace only."""
    return F.coalesce(strip(c) == "", F.lit(True))


def normal_key(c: str | Column) -> Column:
    return F.lower(F.trim(_col(c)))


def canonical_key(c: str | Column, aliases: Mapping[str, str] | None = None) -> Column:
    """A spelling-tolerant join key: lower case, no accents, ``_`` as blank, single blanks, known aliases merged."""
    plain = F.translate(F.lower(_col(c)), ACCENTED + "_", PLAIN + " ")
    key = F.trim(F.regexp_replace(plain, r"\s+", " "))
    if not aliases:
        return key
    merged = None
    for alias, name in aliases.items():
        merged = F.when(key == alias, name) if merged is None else merged.when(key == alias, name)
    return merged.otherwise(key)
