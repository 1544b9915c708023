"""Facts joined to the history row that was valid at their own time, without a range join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltline.operators.scd import Validity
from siltline.session import settle

#: Days of a time range, and facts of one key and range that a task takes, about.
RANGE_DAYS, RANGE_ROWS = 30, 1_000_000
#: A key and range is hot if it holds more than this fraction of all facts; there are fewer than 1000 of them.
HOT_SHARE = 1000
_DAY = 86_400_000_000
_KEY, _TIME, _RANGE, _PART, _STATE, _FACT = "_key", "_time", "_range", "_part", "_state", "_fact"


def _moment(c: str | Column) -> Column:
    return (F.col(f"`{c}`") if isinstance(c, str) else c).cast("timestamp")


def at_own_time(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    fact_time: str,
    history_key: str,
    columns: Mapping[str, str],
    names: Validity = Validity(),
    range_days: int = RANGE_DAYS,
    range_rows: int = RANGE_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """``facts`` with ``columns`` (history column to output name) of the history row valid at ``fact_time``; nulls where none is.

    A row of history is valid from its start (included) to its end (excluded); rows of one key must not overlap, as a
    snapshot leaves them. Of rows that start at one moment the one that ends last counts. Facts without a key or time
    stay, with nulls; repeated facts stay as often as they are there.

    Facts and history are put in one order of key and time, where each fact takes the last history row before it. A
    key is cut into ranges of ``range_days``; the history row that is open when a range begins is carried over from the
    ranges before, by a window over one row per key and range. A range of a key that still holds more than
    ``range_rows`` facts, and more than 1/``hot_share`` of all, is dealt over several parts by a hash of the facts, and each part gets the history of the range. The
    table of those is broadcast: it has fewer than ``hot_share`` rows. Facts are shuffled once, and never
    compared with history rows other than the one that they meet.
    """
    width = F.lit(range_days * _DAY)
    spot = lambda time: F.floor(F.unix_micros(time) / width).cast("long")
    kind = facts.schema[fact_key].dataType
    far = F.lit("9999-12-31 00:00:00").cast("timestamp")
    ends = F.coalesce(_moment(names.end), far)
    state = F.struct(_moment(names.start).alias("start"), ends.alias("end"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])

    keyed = F.col(f"`{fact_key}`").isNotNull() & _moment(fact_time).isNotNull()
    rows = facts.where(keyed).select(
        F.col(f"`{fact_key}`").alias(_KEY), _moment(fact_time).alias(_TIME), spot(_moment(fact_time)).alias(_RANGE),
        F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(facts.columns)]).alias(_FACT))
    past = history.where(F.col(f"`{history_key}`").isNotNull() & _moment(names.start).isNotNull()).select(
        F.col(f"`{history_key}`").cast(kind).alias(_KEY), _moment(names.start).alias(_TIME), spot(_moment(names.start)).alias(_RANGE), state.alias(_STATE))

    held = settle(rows.groupBy(_KEY, _RANGE).agg(F.count("*").alias("n")), "ranges")
    lasts = past.groupBy(_KEY, _RANGE).agg(F.max(_STATE).alias(_STATE))
    before = Window.partitionBy(_KEY).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    openings = held.unionByName(lasts, allowMissingColumns=True).groupBy(_KEY, _RANGE).agg(F.max(_STATE).alias(_STATE), F.max("n").alias("n"))
    openings = openings.withColumn(_STATE, F.last(_STATE, ignorenulls=True).over(before)).where(F.col("n").isNotNull() & F.col(_STATE).isNotNull())
    openings = openings.select(_KEY, F.lit(None).cast("timestamp").alias(_TIME), _RANGE, _STATE)

    hot = held.where((F.col("n") > range_rows) & (F.col("n") * hot_share > held.agg(F.sum("n")).scalar()))
    parts = F.broadcast(hot.select(_KEY, _RANGE, F.ceil(F.col("n") / range_rows).cast("int").alias("_parts")))
    n = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(parts, [_KEY, _RANGE], "left").withColumn(_PART, F.pmod(F.xxhash64(_FACT, _TIME), n).cast("int")).drop("_parts")
    known = past.unionByName(openings).join(parts, [_KEY, _RANGE], "left").withColumn(_PART, F.explode(F.sequence(F.lit(0), n - 1))).drop("_parts")

    line = dealt.unionByName(known, allowMissingColumns=True)
    upto = Window.partitionBy(_KEY, _RANGE, _PART).orderBy(
        F.col(_TIME).asc_nulls_first(), F.col(_FACT).isNotNull(), F.col(f"{_STATE}.end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = line.withColumn(_STATE, F.last(_STATE, ignorenulls=True).over(upto)).where(F.col(_FACT).isNotNull())
    valid = F.col(_TIME) < F.col(f"{_STATE}.end")
    own = [F.col(f"{_FACT}.f{i}").alias(c) for i, c in enumerate(facts.columns)]
    out = met.select(*own, *[F.when(valid, F.col(f"{_STATE}.v{i}")).alias(name) for i, name in enumerate(columns.values())])
    gaps = [F.lit(None).cast(history.schema[c].dataType).alias(name) for c, name in columns.items()]
    loose = facts.where(~keyed).select(*[F.col(f"`{c}`") for c in facts.columns], *gaps)
    return out.unionByName(loose)
