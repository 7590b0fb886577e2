"""Embedding near-duplicates through a pivot-permutation index.

Reference points are drawn from a bounded sample so that no two lie close.  A
vector is described by its nearest pivots; inverted lists under every pair of
them bring together exactly the vectors that share two pivots or more, and the
cosine is then computed on the whole vectors in double precision.  A pair may
meet in several lists and counts in the first of those it shares.  Long lists
are cut into blocks that meet two at a time, in tasks of their own, which
return counts and a spanning set of links instead of pairs.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.llm.common import saved
from terraloom.llm.graph import components

#: Vectors the pivots are chosen from: those with the lowest hashes, so many at most.
SAMPLED = 4096
PIVOTS, NEAREST = 256, 6
#: Pivots are less alike than this.
APART = 0.5
BLOCK, TASK_ROWS = 1024, 16_384


def usable(vector: str | Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def choose(sample: list[list[float]], wanted: int = PIVOTS, apart: float = APART) -> np.ndarray:
    """Unit pivots from the sample in its order, each far from those before; short vectors are filled with zeros.

    Few far pivots serve better than many close ones: two reference points inside
    one dense group are ordered by chance.
    """
    if not sample:
        return np.zeros((0, 0))
    rows = np.zeros((len(sample), max(map(len, sample))))
    for i, v in enumerate(sample):
        rows[i, : len(v)] = v
    rows = unit(rows)
    out = [0]
    closest = rows @ rows[0]
    for i in range(1, len(rows)):
        if len(out) < wanted and closest[i] < apart:
            out.append(i)
            closest = np.maximum(closest, rows @ rows[i])
    return rows[out]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nearest(vectors: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """The nearest pivots of unit vectors, by number."""
    width = min(vectors.shape[1], pivots.shape[1])
    near = vectors[:, :width] @ pivots[:, :width].T
    count = min(count, near.shape[1])
    return np.sort(np.argpartition(-near, count - 1, axis=1)[:, :count], axis=1)


LISTED = "cell long, dim int, node long, weight long, near array<int>, vector array<double>"
_LISTED = pa.schema([("cell", pa.int64()), ("dim", pa.int32()), ("node", pa.int64()), ("weight", pa.int64()),
                     ("near", pa.list_(pa.int32())), ("vector", pa.list_(pa.float64()))])


def _listed(pivots: np.ndarray, count: int):
    """A row for every two nearest pivots of a vector."""

    def run(batches):
        for batch in batches:
            frame = batch.to_pandas()
            for dim, part in frame.groupby(frame.vector.map(len)):
                for at in range(0, len(part), 2048):
                    some = part.iloc[at: at + 2048]
                    rows = np.array(some.vector.tolist(), np.float64)
                    near = nearest(unit(rows), pivots, count)
                    twos = list(combinations(range(near.shape[1]), 2)) or [(0, 0)]
                    cell = np.stack([near[:, a] * len(pivots) + near[:, b] for a, b in twos], 1)
                    each = np.repeat(np.arange(len(some)), cell.shape[1])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(cell.ravel()), pa.array(np.full(len(each), dim, np.int32)), pa.array(some.node.to_numpy()[each]),
                        pa.array(some.weight.to_numpy()[each]), pa.array(list(near[each].astype(np.int32)), pa.list_(pa.int32())),
                        pa.array(list(rows[each]), pa.list_(pa.float64()))], schema=_LISTED)

    return run


def _first_shared(a: np.ndarray, b: np.ndarray, pivots: int) -> np.ndarray:
    """The first list in which the vectors with these nearest pivots meet (rows ascend)."""
    shared = (a[:, :, None] == b[:, None, :]).any(2)
    one = shared.argmax(1)
    rows = np.arange(len(a))
    shared[rows, one] = False
    two = np.where(shared.any(1), shared.argmax(1), one)
    return a[rows, one] * pivots + a[rows, two]


def _verified(least: float, pivots: int):
    """Counts and links of one group of list blocks: node, links, other."""

    def block(cell: int, left: pd.DataFrame, right: pd.DataFrame | None):
        x = unit(np.array(left.vector.tolist(), np.float64))
        y = x if right is None else unit(np.array(right.vector.tolist(), np.float64))
        other = left if right is None else right
        a, b = np.nonzero(x @ y.T >= least)
        if right is None:
            a, b = a[a < b], b[a < b]
        if not len(a):
            return None
        near_x, near_y = np.array(left.near.tolist()), np.array(other.near.tolist())
        own = np.concatenate([_first_shared(near_x[a[i: i + 65536]], near_y[b[i: i + 65536]], pivots) for i in range(0, len(a), 65536)]) == cell
        a, b = a[own], b[own]
        if not len(a):
            return None
        nodes = left.node.to_numpy() if right is None else np.concatenate([left.node, right.node])
        weight = left.weight.to_numpy() if right is None else np.concatenate([left.weight, right.weight])
        b = b if right is None else b + len(left)
        links = np.bincount(a, weight[b], len(nodes)) + np.bincount(b, weight[a], len(nodes))
        root = np.arange(len(nodes))
        while True:  # spanning links: everything hangs under the first row it reaches
            new = root.copy()
            np.minimum.at(new, a, root[b])
            np.minimum.at(new, b, root[a])
            new = new[new]
            if (new == root).all():
                break
            root = new
        hit = np.flatnonzero(links)
        return pd.DataFrame({"node": nodes[hit], "links": links[hit].astype(np.int64), "other": nodes[root[hit]]})

    def run(table: pa.Table) -> pa.Table:
        frame = table.select(["cell", "dim", "low", "high", "side", "node", "weight", "near", "vector"]).to_pandas()
        found = []
        for (cell, _, low, high), part in frame.groupby(["cell", "dim", "low", "high"], sort=False):
            if low == high:
                found.append(block(cell, part, None))
            else:
                found.append(block(cell, part[part.side == low], part[part.side == high]))
        found = [f for f in found if f is not None] or [pd.DataFrame({"node": [], "links": [], "other": []}, dtype=np.int64)]
        return pa.Table.from_pandas(pd.concat(found), preserve_index=False).cast(
            pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())]))

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS,
                    nearest_pivots: int = NEAREST) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row; links have a cosine of ``least`` or more.

    All links found are true; pairs sharing fewer than two nearest pivots are
    missed, which is rare at 0.9 (README has the measured recall) and takes
    fewer pivots or more of the nearest to mend.  Equal vectors are one node and
    link with each other.  Null, zero and non-finite vectors link with nothing;
    so do rows without an id, which have no component and are not kept.  Vectors
    of different lengths do not link.  Other columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumns({
        "k1": F.when(usable("vector") & F.col("vec_id").isNotNull(), F.xxhash64("vector")), "k2": F.xxhash64(F.lit(4), "vector")})
    classes = rows.filter(F.col("k1").isNotNull()).groupBy("k1", "k2").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"), F.any_value("vector").alias("vector"))
    nodes = saved(classes, "vectors")
    sample = [r["vector"] for r in nodes.orderBy("k1", "k2").limit(SAMPLED).select("vector").collect()]
    points = choose(sample, pivots)
    listed = saved(nodes.select("node", "weight", "vector").mapInArrow(_listed(points, nearest_pivots), LISTED), "lists") if len(points) else None
    if listed is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))

    # A list alone has no pairs; a long one is cut into blocks, and every two blocks meet once.
    sizes = listed.groupBy("cell", "dim").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        "cell", "dim", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    side = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    placed = (
        listed.join(sizes, ["cell", "dim"]).withColumn("side", side)
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"low": F.least("side", "_with"), "high": F.greatest("side", "_with")})
    )
    count = listed.count()
    tasks = max(1, math.ceil(count / TASK_ROWS), min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(count / 1000)))
    spread = F.pmod(F.xxhash64("cell", "dim", "low", "high"), F.lit(tasks)).cast("int")
    # Whole lists share a task; each meeting of two blocks has one for itself.
    group = F.when(F.col("_blocks") == 1, F.struct(spread.alias("t"), F.lit(-1).cast("long").alias("c"), F.lit(0).alias("d"), F.lit(0).alias("l"), F.lit(0).alias("h"))).otherwise(
        F.struct(spread.alias("t"), F.col("cell").alias("c"), F.col("dim").alias("d"), F.col("low").alias("l"), F.col("high").alias("h")))
    found = saved(
        placed.withColumn("_group", group).groupBy("_group").applyInArrow(_verified(least, len(points)), "node long, links long, other long"), "verified")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select("node", "other"), "node", "other")
    told = rows.drop("vector").join(
        nodes.select("k1", "k2", "node", "weight"), ["k1", "k2"], "left").join(counts, "node", "left").join(parts, "node", "left")
    return told.select(
        "vec_id",
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "node", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
