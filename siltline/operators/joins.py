"""Joins of a large frame to a side that holds every key once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.session import settle

# A side up to this size is broadcast as a whole.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
# A key is hot when it holds more than this fraction of all rows; there are fewer than 1000 such keys.
HOT_SHARE = 1000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Counts the rows of a settled frame and, if they are few, the bytes of their text."""
    if df.count() > rows:
        return False
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0] <= size


def _on(keys: Sequence[str], null_safe: bool) -> Column:
    sides = [(F.col(f"`{k}`"), F.col(f"`_side_{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) if null_safe else l == r for l, r in sides])


def group_join(
    left: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    rows: str,
    null_safe: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Bring figures of groups to their rows: an inner join of ``left`` to a ``side`` unique on ``keys``.

    ``side`` is written once and measured. A small one is broadcast. A larger one is split by the
    number of left rows per key, which its column ``rows`` holds: a key with more than 1/``hot_share``
    of all rows is hot, so the hot part has fewer than ``hot_share`` rows and is broadcast, and the rows of
    hot keys stay where they are. The rows of all other keys take a shuffled join, in which no key is
    larger than 1/``hot_share`` of the table. Every row is in exactly one of the two parts.
    """
    known = settle(side, "groups")
    extra = [c for c in side.columns if c not in keys and c != rows]
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    columns, condition = quoted([*left.columns, *extra]), _on(keys, null_safe)
    slim = lambda df: df.select(*[F.col(f"`{k}`").alias(f"_side_{k}") for k in keys], *quoted(extra))
    if fits_broadcast(known, broadcast_rows):
        return left.join(F.broadcast(slim(known)), condition).select(*columns)
    hot_now = F.col(rows) * hot_share > known.agg(F.sum(rows)).scalar()
    hot, cold = slim(known.where(hot_now)), slim(known.where(~hot_now))
    from_hot = left.join(F.broadcast(hot), condition).select(*columns)
    others = left.join(F.broadcast(hot), condition, "left_anti")
    return from_hot.unionByName(others.join(cold, condition).select(*columns))
