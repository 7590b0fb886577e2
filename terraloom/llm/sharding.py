"""Sharding by sampled splitters.

Records are ordered by a key: the hash of the text, then the id, so that equal
texts stand side by side.  A size-weighted sample of keys gives splitters, the
splitters cut the key order into many ranges, and overfull ranges are sampled
again and cut further.  Bytes and rows before each range then place every
record in the global order without sorting all of it in one place, and shards
are runs of that order with equal bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from terraloom.llm.common import saved, text_bytes, unit

Key = tuple[int, int, int]

#: Records of a range, whose order is found in one task.
RANGE_ROWS = 500_000


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size, checksum and the three key columns; texts stay behind."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (text_bytes(text) + 1).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.xxhash64(body).alias("_k1"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("_k2"),
        F.monotonically_increasing_id().alias("_k3"),
    )


def _ordered(columns) -> np.ndarray:
    """Keys as byte strings of one length that sort as the keys do."""
    shifted = [np.asarray(c, np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns]
    return np.ascontiguousarray(np.stack(shifted, axis=1).astype(">u8")).view("S24").ravel()


def _place(bounds: list[Key], name: str):
    """Adds the number of bounds at or below each row's key; all other columns stay in Arrow as they are."""

    def run(batches):
        edges = _ordered(list(zip(*bounds))) if bounds else np.zeros(0, "S24")
        for b in batches:
            keys = _ordered([b.column(k).to_numpy() for k in ("_k1", "_k2", "_k3")])
            at = pa.array(np.searchsorted(edges, keys, "right"), pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, at], names=[*b.schema.names, name])

    return run


def place(df: DataFrame, bounds: list[Key], name: str) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name != name)
    return df.drop(name).mapInArrow(_place(bounds, name), f"{schema}, {name} int")


def sample(df: DataFrame, total: int, wanted: int) -> list[Key]:
    """About ``wanted`` keys, each row drawn in proportion to its size; sorted."""
    drawn = df.filter(unit("_k1", "_k2", "_k3", seed=8) * float(total) < F.col("size") * float(wanted))
    return sorted(tuple(r) for r in drawn.select("_k1", "_k2", "_k3").collect())


def _quantiles(keys: list[Key], parts: int) -> list[Key]:
    return [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []


def splitters(df: DataFrame, total: int, ranges: int, per_range: int = 32, full: float = 2.0) -> list[Key]:
    """Bounds of about ``ranges`` ranges, none with over ``full`` times its share of bytes
    unless it is a single record.  The driver sees ``ranges * per_range`` keys at once."""
    bounds = sorted(set(_quantiles(sample(df, total, ranges * per_range), ranges)))
    while True:
        over = {
            r["_range"]: r["bytes"]
            for r in place(df, bounds, "_range").groupBy("_range")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
            .filter((F.col("bytes") > full * total / ranges) & (F.col("n") > 1)).collect()
        }
        if not over:
            return bounds
        inside = place(df, bounds, "_range").filter(F.col("_range").isin(list(over)))
        weight = sum(over.values())
        keys = sample(inside, weight, max(64, per_range * (weight * ranges // total + 1)))
        cut = _quantiles(keys, min(len(keys), 2 * int(weight * ranges // total + 1)))
        more = sorted(set(bounds) | set(cut))
        if len(more) == len(bounds):
            return bounds
        bounds = more


def by_bytes(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None,
             together: float = 0.01) -> DataFrame:
    """Shards of nearly equal bytes: doc_id, size, text_crc32, shard, slot.

    A group of equal texts stays in one shard if it holds at most ``together``
    of a shard's bytes; a larger one may be cut where a shard is full.  So shards
    differ by at most two such groups or one record, whichever is more.

    Null texts have size 1 (as empty ones do); null ids and repeated rows are
    records of their own; an empty table gives no rows.  Other columns of
    ``docs``, whatever their names, are not read.
    """
    df = saved(keyed(docs, doc_id, text), "shard-keys")
    whole = df.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    total = whole["bytes"]
    ranges = ranges or max(shards * 8, math.ceil(whole["n"] / RANGE_ROWS))
    bounds = splitters(df, total, ranges) if total else []
    df = place(df, bounds, "_range")

    # Bytes and rows before each range: a handful of numbers.
    sums = {r["_range"]: (r["bytes"], r["n"]) for r in df.groupBy("_range").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()}
    before, at_bytes, at_rows = [], 0, 0
    for i in range(len(bounds) + 1):
        before.append((i, at_bytes, at_rows))
        b, n = sums.get(i, (0, 0))
        at_bytes, at_rows = at_bytes + b, at_rows + n
    starts = df.sparkSession.createDataFrame(before, "_range int, _bytes long, _rows long")
    order = Window.partitionBy("_range").orderBy("_k1", "_k2", "_k3")
    df = df.join(F.broadcast(starts), "_range").withColumns({
        "_end": F.col("_bytes") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "_rank": F.col("_rows") + F.row_number().over(order) - 1,
    })
    df = saved(df.drop("_range", "_bytes", "_rows"), "shard-order")

    df = place(df, _shard_bounds(df, total, shards, together), "shard")
    first = df.groupBy("shard").agg(F.min("_rank").alias("_first"))  # one row per shard
    return df.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).cast("long").alias("slot"))


def _shard_bounds(df: DataFrame, total: int, shards: int, together: float) -> list[Key]:
    """First keys of the shards after the first, moved to the edge of a small group of copies."""
    share = total / shards
    middle = F.col("_end") - F.col("size") / 2
    # A record is the first of a new shard where its middle passes a multiple of the share.
    number = F.floor(middle / F.lit(share or 1.0)).cast("int")
    firsts = (
        df.withColumn("_s", number).groupBy("_s").agg(F.min(F.struct("_k1", "_k2", "_k3")).alias("k"))
        .orderBy("_s").collect()  # one row per shard
    )
    cuts = {r["_s"]: tuple(r["k"]) for r in firsts if r["_s"] > 0}
    groups = {
        r["_k1"]: r for r in df.filter(F.col("_k1").isin([k[0] for k in cuts.values()])).groupBy("_k1").agg(
            F.sum("size").alias("bytes"), F.max("_end").alias("end"), F.max(F.struct("_k2", "_k3")).alias("last")
        ).collect()
    } if cuts else {}
    low, bounds = -(1 << 63), []
    for i, key in sorted(cuts.items()):
        g = groups[key[0]]
        if g["bytes"] <= together * share:
            goes_right = i * share - (g["end"] - g["bytes"]) <= g["end"] - i * share
            key = (key[0], low, -1) if goes_right else (g["_k1"], g["last"][0], g["last"][1] + 1)
        bounds.append(key)
    # A shard without a first record of its own is empty: its bound is the next one's.
    full, missing = [], sorted(set(range(1, shards)) - set(cuts))
    it = dict(zip(sorted(cuts), bounds))
    nxt = ((1 << 63) - 1,) * 3  # above every key
    for i in range(shards - 1, 0, -1):
        nxt = it.get(i, nxt) if i not in missing else nxt
        full.append(nxt)
    return sorted(full)
