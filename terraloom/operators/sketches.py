"""Mergeable summaries of tile arrays: quantile sketches and histograms.

A sketch is a row of ordered values with weights.  It is made per tile array,
stored, and merged per scene, region or year without the cells.  Making or
merging one joins neighbours until at most ``points`` are left; the rank of any
value is then off by at most what the largest joined weight allows, and this
error is added up in the sketch itself, so a quantile comes with its bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

POINTS = 512
SKETCH = "struct<n: bigint, error: bigint, low: double, high: double, values: array<double>, weights: array<bigint>>"
_KIND = StructType([
    StructField("n", LongType()), StructField("error", LongType()), StructField("low", DoubleType()), StructField("high", DoubleType()),
    StructField("values", ArrayType(DoubleType())), StructField("weights", ArrayType(LongType()))])
_ARROW = pa.struct([("n", pa.int64()), ("error", pa.int64()), ("low", pa.float64()), ("high", pa.float64()),
                    ("values", pa.list_(pa.float64())), ("weights", pa.list_(pa.int64()))])
#: Keys whose sketches a merging task holds before it hands them on.
HELD = 1000


def pressed(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray, int]:
    """At most ``points`` ordered values with their weights, and by how much a rank may be off.

    ``values`` are sorted.  Equal values are one.  Neighbours become one point,
    the last of them, while their weights stay within a share of the whole.
    """
    if len(values):
        head = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        values, weights = values[head], np.add.reduceat(weights, head)
    if len(values) <= points:
        return values, weights, 0
    ends = np.cumsum(weights)
    # A quarter as many shares: points that outweigh one stay alone and exact, and part their neighbours.
    share = -(-int(ends[-1]) // max(1, points // 4))
    alone = weights >= share
    group = (ends - 1) // share
    group = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]) | alone[1:] | alone[:-1]]))
    last = np.flatnonzero(np.concatenate([group[1:] != group[:-1], [True]]))
    head = np.concatenate([[0], last[:-1] + 1])
    joined = np.add.reduceat(weights, head)
    several = last > head
    # Below the last of its neighbours a rank may miss all the others.
    error = int((joined - weights[last])[several].max(initial=0))
    return values[last], joined, error


def sketch(data: str | Column, points: int = POINTS) -> Column:
    """The sketch of each tile array; NaN cells are left out, an array without cells has n = 0."""

    @F.arrow_udf(_KIND)
    def run(column: pa.Array) -> pa.Array:
        ends, cells = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        there, out = column.is_valid().to_numpy(zero_copy_only=False), []
        for k in range(len(column)):
            own = cells[ends[k]:ends[k + 1]].astype(np.float64) if there[k] else np.zeros(0)
            own = np.sort(own[~np.isnan(own)])
            values, weights, error = pressed(own, np.ones(len(own), np.int64), points)
            out.append(_entry(len(own), error, own[0] if len(own) else None, own[-1] if len(own) else None, values, weights))
        return pa.array(out, _ARROW)

    return run(F.col(data) if isinstance(data, str) else data)


def _entry(n, error, low, high, values, weights) -> dict:
    return {"n": int(n), "error": int(error), "low": None if low is None else float(low), "high": None if high is None else float(high),
            "values": values, "weights": weights}


class Merged:
    """The running merge of sketches: pressed whenever it has grown to several times its size."""

    def __init__(self, points: int):
        self.points, self.n, self.error, self.low, self.high = points, 0, 0, np.inf, -np.inf
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, s: dict) -> None:
        if not s["n"]:
            return
        self.n, self.error = self.n + s["n"], self.error + s["error"]
        self.low, self.high = min(self.low, s["low"]), max(self.high, s["high"])
        self.parts.append((np.asarray(s["values"], float), np.asarray(s["weights"], np.int64)))
        self.held += len(s["values"])
        if self.held > 256 * self.points:
            self.press()

    def press(self) -> None:
        if not self.parts:
            return
        values, weights = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(values, kind="stable")
        values, weights, error = pressed(values[order], weights[order], self.points)
        self.parts, self.held, self.error = [(values, weights)], len(values), self.error + error

    def done(self) -> dict:
        self.press()
        values, weights = self.parts[0] if self.parts else (np.zeros(0), np.zeros(0, np.int64))
        return _entry(self.n, self.error, self.low if self.n else None, self.high if self.n else None, values, weights)


def merge(sketches: DataFrame, keys, column: str = "sketch", points: int = POINTS) -> DataFrame:
    """One sketch per key: ``<keys>, <column>``.

    Tasks merge what they have first, so that a key gets a row per task at most
    and a hot one holds no more.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keys = list(keys)
    rows = sketches.select(*keys, F.col(column).cast(SKETCH).alias("_s"))
    schema = rows.select(*keys).schema
    arrow = pa.schema([*to_arrow_schema(schema), ("_s", _ARROW)])
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema], f"_s {SKETCH}"])

    def out(held):
        return pa.RecordBatch.from_arrays(
            [*[pa.array([k[n] for k in held], arrow.field(n).type) for n in range(len(keys))], pa.array([m.done() for m in held.values()], _ARROW)], schema=arrow)

    def within(batches):
        held: dict[tuple, Merged] = {}
        for batch in batches:
            names = [batch.column(k).to_pylist() for k in keys]
            for row, s in zip(zip(*names) if keys else [()] * batch.num_rows, batch.column("_s").to_pylist()):
                if row not in held and len(held) >= HELD:
                    yield out(held)
                    held = {}
                held.setdefault(row, Merged(points)).add(s)
        if held:
            yield out(held)

    def across(key: tuple, table: pa.Table) -> pa.Table:
        whole = Merged(points)
        for s in table.column("_s").to_pylist():
            whole.add(s)
        return pa.Table.from_batches([out({tuple(k.as_py() for k in key): whole})])

    some = rows.mapInArrow(within, ddl)
    grouped = some.groupBy(*keys) if keys else some.groupBy()
    return grouped.applyInArrow(across, ddl).withColumnRenamed("_s", column)


def quantiles(column: str | Column, shares) -> Column:
    """Values at the shares: the least value whose rank reaches share * n, as far as the sketch knows; nulls without cells."""

    @F.arrow_udf("array<double>")
    def run(sketches: pa.Array) -> pa.Array:
        out = []
        for s in sketches.to_pylist():
            if s is None or not s["n"]:
                out.append(None)
                continue
            ends = np.cumsum(s["weights"])
            at = np.searchsorted(ends, np.maximum(np.ceil(np.asarray(shares) * s["n"] - 1e-9), 1))
            out.append(np.asarray(s["values"])[np.minimum(at, len(ends) - 1)])
        return pa.array(out, pa.list_(pa.float64()))

    return run(F.col(column) if isinstance(column, str) else column)


def rank_error(column: str = "sketch") -> Column:
    """Greatest share of the cells by which a quantile's rank may be off."""
    return F.when(F.col(f"{column}.n") > 0, F.col(f"{column}.error") / F.col(f"{column}.n"))


def histogram(data: str | Column, low: float = -0.5, width: float = 1.0, bins: int = 256) -> Column:
    """Cells per bin of each tile array; cells outside of the range are left out."""

    @F.arrow_udf("array<bigint>")
    def run(column: pa.Array) -> pa.Array:
        ends = column.offsets.to_numpy()
        own = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(ends), 0)
        rows = np.repeat(np.arange(len(column)), own)
        cells = column.values.to_numpy(zero_copy_only=False)[np.repeat(ends[:-1] - (np.cumsum(own) - own), own) + np.arange(own.sum())].astype(np.float64)
        with np.errstate(invalid="ignore"):
            at = np.floor((cells - low) / width)
            keep = (at >= 0) & (at < bins)
        counts = np.bincount(rows[keep] * bins + at[keep].astype(np.int64), minlength=len(column) * bins)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1) * bins, pa.int32()), pa.array(counts, pa.int64()))

    return run(F.col(data) if isinstance(data, str) else data)


def merge_histograms(histograms: DataFrame, keys, column: str = "histogram") -> DataFrame:
    """``<keys>, bin, cells`` of histograms with the same bins, empty bins left out."""
    keys = list(keys)
    rows = histograms.select(*keys, F.posexplode(column).alias("bin", "_n")).filter(F.col("_n") > 0)
    return rows.groupBy(*keys, "bin").agg(F.sum("_n").alias("cells"))
