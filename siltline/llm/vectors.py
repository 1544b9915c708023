"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import Scratch, partitions
from siltline.llm.components import components

COSINE = 0.95
#: Neighbours that a vector is compared with in each pass, and bits of its sort key.
NEIGHBOURS, BITS, SEED = 64, 60, 8
#: Pairs at the limit that may be missed, in expectation, as a part of all.
MISSED = 1e-3
#: Vectors of a ball that are compared at once.
BLOCK = 512
#: Above the limit by so much, rounding can't matter.
_SAFE = 1e-9


def passes(rows: int, cosine: float = COSINE) -> int:
    """Passes after which a pair at the limit has been in one window with probability 1 - ``MISSED``.

    Two vectors share a bit with probability 1 - angle / pi, and lie within a window when they share about
    log2(rows / window) leading bits.
    """
    shared = max(0.0, math.log2(max(rows, 1) / NEIGHBOURS) + 1)
    meet = (1 - math.acos(cosine) / math.pi) ** shared
    return 1 if meet >= 1 - MISSED else math.ceil(math.log(MISSED) / math.log(1 - meet))


def _unit(values: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the usable vectors, and the vectors with length one."""
    at, out = [], []
    for i, v in enumerate(values):
        if not v.is_valid:
            continue
        x = v.values
        if not len(x) or x.null_count:
            continue
        x = x.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
            x = x / top
            at.append(i)
            out.append(x / math.sqrt(float(x @ x)))
    return np.array(at, np.int64), out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, units = _unit(batch.column(1))
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(at)), pa.array([len(u) for u in units], pa.int32()), pa.array([u.tobytes() for u in units], pa.binary())],
            names=["node", "dim", "unit"])


def _planes(dim: int, turn: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(key=SEED, counter=[dim, turn, 0, 0])).standard_normal((dim, BITS))


def _keys(units: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Signs of the projections, the first in the highest bit."""
    return ((units @ planes > 0).astype(np.int64) << np.arange(BITS - 1, -1, -1)).sum(1)


def _turned(turns: int, single: bool):
    """Rows (turn, dim, key, node, reach, unit) for every pass; the units in single precision if they only propose."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            node, dims, reach = batch["node"].to_numpy(), batch["dim"].to_numpy(), batch["reach"].to_numpy()
            raw = batch["unit"].to_pylist()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                units = np.frombuffer(b"".join(raw[i] for i in own), np.float64).reshape(-1, dim)
                kept = units.astype(np.float32) if single else units
                packed = pa.array([u.tobytes() for u in kept], pa.binary())
                for turn in range(turns):
                    if (dim, turn) not in planes:
                        planes[dim, turn] = _planes(int(dim), turn)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(own), turn, np.int32)), pa.array(np.full(len(own), dim, np.int32)), pa.array(_keys(units, planes[dim, turn])),
                        pa.array(node[own]), pa.array(reach[own]), packed], names=["turn", "dim", "key", "node", "reach", "unit"])

    return run


_TURNED = "turn int, dim int, key long, node long, reach double, unit binary"


def _balls(limit: float):
    """Sorted rows: each vector joins one of the last leaders if it is within half the limit's angle, or leads."""
    near = math.cos(math.acos(limit) / 2) + _SAFE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, leaders, ids, at = None, None, [], 0
        for batch in batches:
            node, dims, raw = batch["node"].to_numpy(), batch["dim"].to_numpy(), batch["unit"].to_pylist()
            lead, cosine = node.copy(), np.ones(len(node))
            for i, x in enumerate(raw):
                if dims[i] != dim:
                    dim, ids, at = dims[i], [], 0
                    leaders = np.zeros((NEIGHBOURS, dim))
                x = np.frombuffer(x, np.float64)
                if ids:
                    c = leaders[:len(ids)] @ x
                    k = int(c.argmax())
                    if c[k] >= near:
                        lead[i], cosine[i] = ids[k], min(1.0, c[k])
                        continue
                if len(ids) < NEIGHBOURS:
                    leaders[len(ids)] = x
                    ids.append(node[i])
                else:
                    leaders[at], ids[at] = x, node[i]
                    at = (at + 1) % NEIGHBOURS
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(lead), pa.array(cosine)], names=["node", "lead", "cosine"])

    return run


def _propose(limit: float):
    """Sorted rows: pairs of balls in one window that can hold a link."""
    angle = math.acos(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
            old = 0 if held is None else held.num_rows
            turn, dims, node, reach = (rows[c].to_numpy() for c in ("turn", "dim", "node", "reach"))
            raw, a, b = rows["unit"].to_pylist(), [], []
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(raw[i] for i in own), np.float32).reshape(-1, dim)
                for step in range(1, min(NEIGHBOURS, len(own) - 1) + 1):
                    i, j = own[:-step], own[step:]
                    least = np.cos(np.minimum(math.pi, angle + reach[i] + reach[j])) - 1e-4
                    hit = (turn[i] == turn[j]) & (j >= old) & (np.einsum("ij,ij->i", x[:-step], x[step:]) >= least)
                    a.append(node[i[hit]])
                    b.append(node[j[hit]])
            pairs = np.stack([np.concatenate(a or [node[:0]]), np.concatenate(b or [node[:0]])])
            pairs = np.unique(np.stack([pairs.min(0), pairs.max(0)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(p)) for p in pairs], names=["a", "b"])
            held = rows.slice(max(0, rows.num_rows - NEIGHBOURS))

    return run


def _judge(limit: float):
    """Pairs of balls: all their vectors linked, none, one link of single vectors, or to be compared."""
    angle = math.acos(limit)

    def run(a: pa.Array, b: pa.Array, reach_a: pa.Array, reach_b: pa.Array) -> pa.Array:
        cosine = np.array([float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)])
        reach = reach_a.to_numpy() + reach_b.to_numpy()
        between = np.arccos(np.clip(cosine, -1, 1))
        out = np.where(between + reach <= angle - 1e-7, "all", np.where(between - reach > angle + 1e-7, "none", "some"))
        return pa.array(np.where(reach == 0, np.where(cosine >= limit, "all", "none"), out).astype(object), pa.string())

    return F.arrow_udf(run, "string")


def _blocks(limit: float):
    """Rows (a, b, ids, units of a block of a, the same of b): links by vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            node, links = [], []
            for a, b, ia, ua, ib, ub in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                dim = len(ua[0]) // 8
                hit = np.frombuffer(b"".join(ua), np.float64).reshape(-1, dim) @ np.frombuffer(b"".join(ub), np.float64).reshape(-1, dim).T >= limit
                if hit.any():
                    node += [*ia, *ib]
                    links += [*hit.sum(1).tolist(), *hit.sum(0).tolist()]
                    left += [a] * (len(ia) + len(ib))
                    right += [b] * (len(ia) + len(ib))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (left, right, node, links)], names=["a", "b", "node", "links"])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row ``(vec_id, n_links, component_id, kept)`` per row of ``vectors(vec_id, embedding)``; others are not read.

    Two vectors of one length are linked if their cosine, in double precision, is at least ``cosine``. Null, empty and
    zero vectors and those with null or non-finite components have no link and are their own component. ``component_id``
    is the smallest vec_id that links reach, ``kept`` whether it is the row's own (a null vec_id is kept if its
    component has no id). Repeated rows are linked with each other.

    Vectors are sorted by concatenated random projection signs. First, each joins a leader among the last ones in
    that order if it is within half the limit's angle: all vectors of such a ball are linked with each other, whatever
    their number, without comparing them. Then the leaders are sorted anew in several passes, and compared with a
    bounded window of neighbours. A pair of balls that the triangle inequality doesn't settle is compared vector by
    vector in blocks. Every link is a cosine above the limit or follows from the angles; passes are as many as leave
    a pair at the limit unseen with a probability below ``MISSED``.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = scratch.save(vectors.select("vec_id", "embedding", F.monotonically_increasing_id().alias("node")))
    units = scratch.save(rows.select("node", "embedding").mapInArrow(_units, "node long, dim int, unit binary"))
    n_parts = max(1, partitions(spark))

    def turned(frame: DataFrame, turns: int, single: bool) -> DataFrame:
        order = ["turn", "dim", "key", "node"]
        spread = scratch.save(frame.mapInArrow(_turned(turns, single), _TURNED))
        return spread.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)

    balls = scratch.save(turned(units.withColumn("reach", F.lit(0.0)), 1, False).mapInArrow(_balls(cosine), "node long, lead long, cosine double"))
    sizes = balls.groupBy("lead").agg(F.count("*").alias("n"), F.max(F.when(F.col("cosine") < 1, F.acos("cosine") + 1e-8).otherwise(
        F.when(F.col("node") == F.col("lead"), 0.0).otherwise(1e-7))).alias("reach"))
    leaders = scratch.save(units.join(sizes, units.node == sizes["lead"]).select("node", "dim", "unit", "n", "reach"))
    found = scratch.save(turned(leaders, passes(leaders.count(), cosine), True).mapInArrow(_propose(cosine), "a long, b long").distinct())
    one, two = (leaders.select(F.col("node").alias(x), F.col("unit").alias(f"unit_{x}"), F.col("n").alias(f"n_{x}"), F.col("reach").alias(f"reach_{x}")) for x in "ab")
    judged = scratch.save(found.join(one, "a").join(two, "b").select(
        "a", "b", "n_a", "n_b", _judge(cosine)("unit_a", "unit_b", "reach_a", "reach_b").alias("what")).where("what <> 'none'"))
    whole = judged.where("what = 'all'")
    open_pairs = judged.where("what = 'some'").select("a", "b")
    open_balls = open_pairs.select(F.col("a").alias("lead")).unionByName(open_pairs.select(F.col("b").alias("lead"))).distinct()
    members = balls.join(open_balls, "lead").join(sizes.select("lead", "n"), "lead").join(units.select("node", "unit"), "node")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))
    blocks = scratch.save(members.groupBy("lead", block.alias("block")).agg(
        F.collect_list(F.struct("node", "unit")).alias("m")).select("lead", F.col("m.node").alias("ids"), F.col("m.unit").alias("units")))
    sides = [blocks.select(F.col("lead").alias(x), F.col("ids").alias(f"ids_{x}"), F.col("units").alias(f"units_{x}")) for x in "ab"]
    compared = scratch.save(open_pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "ids_a", "units_a", "ids_b", "units_b").mapInArrow(
        _blocks(cosine), "a long, b long, node long, links long"))
    links = components(whole.select("a", "b").unionByName(compared.select("a", "b").distinct()), scratch)
    by_ball = whole.select(F.col("a").alias("lead"), F.col("n_b").alias("more")).unionByName(
        whole.select(F.col("b").alias("lead"), F.col("n_a").alias("more"))).groupBy("lead").agg(F.sum("more").alias("more"))
    by_node = compared.groupBy("node").agg(F.sum("links").alias("single"))
    per_ball = scratch.save(sizes.join(by_ball, "lead", "left").join(links.withColumnRenamed("node", "lead"), "lead", "left").select(
        "lead", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("own"), F.coalesce("label", "lead").alias("label")))
    placed = balls.select("node", "lead").join(per_ball, "lead").join(by_node, "node", "left").select(
        "node", (F.col("own") + F.coalesce("single", F.lit(0))).alias("n_links"), "label")
    full = scratch.save(rows.select("vec_id", "node").join(placed, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("label", "node").alias("label")))
    least = full.groupBy("label").agg(F.min("vec_id").cast("long").alias("component_id"))
    return full.join(least, "label").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
