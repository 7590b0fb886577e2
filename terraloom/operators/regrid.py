"""Resampling, overlays and pyramids on whole tiles.

A source tile gives each target tile it touches a partial result: weighted sums
and weights of the target cells it has a part in, worked out axis by axis, as
the weights of every method are a product of one per column and one per row.
Partial results of a target tile meet in one shuffle and are added.  So no
halo is gathered, a group holds target cells only, however far the grids differ
in resolution, and no cell is a row.

Grids are related per tile row, by columns: a target cell is ``ratio`` source
cells wide and the target's origin lies ``shift`` source cells from the source's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.operators.spatial import bbox_join

METHODS = ("nearest", "bilinear", "average")
RELATION = ("struct<target: string, level: int, ratio_x: double, ratio_y: double, shift_x: double, shift_y: double, "
            "width: bigint, height: bigint>")
#: Weights below this are rounding of zero.
TINY = 1e-9


def relation(target: Column, level=0, ratio_x=1.0, ratio_y=1.0, shift_x=0.0, shift_y=0.0, width=1 << 40, height=1 << 40) -> Column:
    """One entry of the ``relations`` of a tile row: columns or numbers."""
    def held(v, name, kind):
        return (v if isinstance(v, Column) else F.lit(v)).cast(kind).alias(name)

    return F.struct(
        held(target, "target", "string"), held(level, "level", "int"), held(ratio_x, "ratio_x", "double"), held(ratio_y, "ratio_y", "double"),
        held(shift_x, "shift_x", "double"), held(shift_y, "shift_y", "double"), held(width, "width", "bigint"), held(height, "height", "bigint"))


class Axis:
    """Weights along one axis: which target cells ``n`` source cells from ``first`` on have a part in."""

    def __init__(self, method: str, first: int, n: int, ratio: float, shift: float, width: int):
        self.n, start = n, first - shift
        if method == "average":
            cells = np.floor((start + np.arange(n) + 0.5) / ratio).astype(np.int64)
            keep = (cells >= 0) & (cells < width)
            self.source = np.flatnonzero(keep)
            cells = cells[keep]
            held, self.heads = np.unique(cells, return_index=True)
            # Enlarging leaves targets between that get nothing.
            self.targets = np.arange(held[0], held[-1] + 1) if len(held) else held
            self.places, self.taps = held - held[:1], None
            return
        reach = 1.0 if method == "bilinear" else 0.5
        low = max(0, int(np.floor((start + 0.5 - reach) / ratio - 0.5)) - 1)
        high = min(width - 1, int(np.ceil((start + n - 0.5 + reach) / ratio - 0.5)) + 1)
        targets = np.arange(low, high + 1)
        if method == "nearest":
            near = np.floor((targets + 0.5) * ratio + shift).astype(np.int64) - first
            taps = [(near, np.ones(len(targets)))]
        else:
            at = (targets + 0.5) * ratio - 0.5 + shift - first
            left = np.floor(at).astype(np.int64)
            taps = [(left, 1.0 - (at - left)), (left + 1, at - left)]
        inside = [(i >= 0) & (i < n) & (w > TINY) for i, w in taps]
        keep = np.logical_or.reduce(inside)
        self.targets = targets[keep]
        self.taps = [(np.where(ok, i, 0)[keep], np.where(ok, w, 0.0)[keep]) for (i, w), ok in zip(taps, inside)]

    def sums(self, grid: np.ndarray, axis: int) -> np.ndarray:
        """Weighted sums of the source cells along ``axis`` for each target cell."""
        if self.taps is None:
            out = np.zeros([len(self.targets) if a == axis else n for a, n in enumerate(grid.shape)])
            where = [slice(None)] * grid.ndim
            where[axis] = self.places
            out[tuple(where)] = np.add.reduceat(np.take(grid, self.source, axis), self.heads, axis)
            return out
        shape = [1] * grid.ndim
        shape[axis] = -1
        return sum(np.take(grid, i, axis) * w.reshape(shape) for i, w in self.taps)


def _partials(method: str, size: int, bands: int):
    """Partial results of each tile for each target tile it touches."""
    schema = pa.schema([("target", pa.string()), ("level", pa.int32()), ("tx", pa.int32()), ("ty", pa.int32()),
                        ("place", pa.list_(pa.int32())), ("sums", pa.list_(pa.float64())), ("weights", pa.list_(pa.float64()))])

    def rows(batch):
        cells = [batch.column(f"b{n}") for n in range(bands)]
        starts = [c.offsets.to_numpy() for c in cells]
        flat = [c.values.to_numpy(zero_copy_only=False) for c in cells]
        there = [c.is_valid().to_numpy(zero_copy_only=False) for c in cells]
        keys = {n: batch.column(n).to_pylist() for n in ("tx", "ty", "w", "h", "relations")}
        for k in range(batch.num_rows):
            w, h = keys["w"][k], keys["h"][k]
            stack = np.full((bands, h * w), np.nan)
            for n in range(bands):
                if there[n][k]:
                    own = flat[n][starts[n][k]:starts[n][k + 1]][: h * w]
                    stack[n, : len(own)] = own
            stack = stack.reshape(bands, h, w)
            valid = ~np.isnan(stack)
            stack = np.where(valid, stack, 0.0)
            all_valid = valid.all()
            for r in keys["relations"][k]:
                across = Axis(method, keys["tx"][k] * size, w, r["ratio_x"], r["shift_x"], r["width"])
                down = Axis(method, keys["ty"][k] * size, h, r["ratio_y"], r["shift_y"], r["height"])
                if not len(across.targets) or not len(down.targets):
                    continue
                sums = down.sums(across.sums(stack, 2), 1)
                if all_valid:  # the weights are the same for every band
                    one = down.sums(across.sums(np.ones((1, h, w)), 2), 1)
                    weights = np.broadcast_to(one, sums.shape)
                else:
                    weights = down.sums(across.sums(valid.astype(np.float64), 2), 1)
                for ty in range(int(down.targets[0]) // size, int(down.targets[-1]) // size + 1):
                    y = slice(*np.searchsorted(down.targets, (ty * size, (ty + 1) * size)))
                    for tx in range(int(across.targets[0]) // size, int(across.targets[-1]) // size + 1):
                        x = slice(*np.searchsorted(across.targets, (tx * size, (tx + 1) * size)))
                        if y.start == y.stop or x.start == x.stop:
                            continue
                        place = [int(across.targets[x.start]) - tx * size, int(down.targets[y.start]) - ty * size, x.stop - x.start, y.stop - y.start]
                        yield (r["target"], r["level"], tx, ty, place, sums[:, y, x].ravel(), weights[:, y, x].ravel())

    def run(batches):
        for batch in batches:
            held, cells = [], 0
            for row in rows(batch):
                held.append(row)
                cells += len(row[5])
                if cells >= 1 << 21:  # hand partial results on by size
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*held), schema)], schema=schema)
                    held, cells = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*held), schema)], schema=schema)

    return run


def regrid(tiles: DataFrame, bands, size: int, method: str = "bilinear") -> DataFrame:
    """Tiles on other grids: ``target, level, tx, ty, w, h, <bands>`` with float64 cells.

    ``tiles``: wide tile rows with ``relations`` (an array of ``relation``).
    ``nearest`` takes the cell that holds the target's centre, ``bilinear`` the
    two nearest on each axis, ``average`` the cells whose centre lies inside.
    Missing cells, and cells beyond the raster, are left out of a mean; a target
    cell without any is NaN.  A source cell may belong to one tile row only.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    n = len(bands)
    told = tiles.select("tx", "ty", "w", "h", F.col("relations").cast(f"array<{RELATION}>"), *[F.col(b).cast("array<double>").alias(f"b{k}") for k, b in enumerate(bands)])
    parts = told.mapInArrow(_partials(method, size, n), "target string, level int, tx int, ty int, place array<int>, sums array<double>, weights array<double>")
    result = pa.schema([("target", pa.string()), ("level", pa.int32()), *[(k, pa.int32()) for k in ("tx", "ty", "w", "h")],
                        *[(b, pa.list_(pa.float64())) for b in bands]])

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        sums, weights = np.zeros((n, size, size)), np.zeros((n, size, size))
        for place, some, weight in zip(rows["place"].to_pylist(), rows["sums"], rows["weights"]):
            x, y, w, h = place
            sums[:, y:y + h, x:x + w] += some.values.to_numpy(zero_copy_only=False).reshape(n, h, w)
            weights[:, y:y + h, x:x + w] += weight.values.to_numpy(zero_copy_only=False).reshape(n, h, w)
        with np.errstate(divide="ignore", invalid="ignore"):
            cells = np.where(weights > TINY, sums / weights, np.nan)
        row = [*[k.as_py() for k in key], size, size, *[c.ravel() for c in cells]]
        return pa.table([pa.array([v], f.type) for v, f in zip(row, result)], schema=result)

    return parts.groupBy("target", "level", "tx", "ty").applyInArrow(
        add, "target string, level int, tx int, ty int, w int, h int, " + ", ".join(f"{b} array<double>" for b in bands))


def resize(tiles: DataFrame, bands, size: int, ratio_x, ratio_y, width, height, method: str = "bilinear", shift_x=0.0, shift_y=0.0) -> DataFrame:
    """Every scene on a grid of its own of ``width`` x ``height`` cells: ``resample.to_grid`` on tile rows."""
    told = tiles.withColumn("relations", F.array(relation(F.col("scene"), 0, ratio_x, ratio_y, shift_x, shift_y, width, height)))
    return regrid(told, bands, size, method).withColumnRenamed("target", "scene").drop("level")


def to_resolution(tiles: DataFrame, bands, size: int, res: float, target: float, width: int, height: int, method: str = "bilinear") -> DataFrame:
    """``resample.to_resolution`` on tile rows."""
    ratio = target / res
    return resize(tiles, bands, size, ratio, ratio, max(1, round(width / ratio)), max(1, round(height / ratio)), method)


def pyramid(tiles: DataFrame, bands, size: int, factors, width, height, method: str = "average") -> DataFrame:
    """All overview levels of every scene in one job: ``scene, level, factor, tx, ty, w, h, <bands>``.

    A tile gives every level the sums and counts of its own cells, so the cells
    are read once; level n shrinks by ``factors[n - 1]`` and has whole cells
    only.  ``width`` and ``height`` (numbers or columns) are the scene's.
    """
    of = lambda v: v if isinstance(v, Column) else F.lit(v)
    levels = F.array(*[relation(F.col("scene"), n, f, f, 0.0, 0.0, F.floor(of(width) / f), F.floor(of(height) / f)) for n, f in enumerate(factors, 1)])
    rows = regrid(tiles.withColumn("relations", levels), bands, size, method).withColumnRenamed("target", "scene")
    return rows.withColumn("factor", F.element_at(F.array(*[F.lit(f) for f in factors]), F.col("level")))


def _boxes(tiles: DataFrame, size: int, prefix: str, *keys: str) -> DataFrame:
    """World boxes of tiles from their ``transform`` columns, without their cells."""
    t = F.col("transform")
    x0, x1 = t[0] + F.col("tx") * size * t[1], t[0] + (F.col("tx") + 1) * size * t[1]
    y0, y1 = t[3] + F.col("ty") * size * t[5], t[3] + (F.col("ty") + 1) * size * t[5]
    return tiles.select(
        *[F.col(k).alias(f"{prefix}{k}") for k in keys], t.alias(f"{prefix}transform"),
        F.least(x0, x1).alias(f"{prefix}minx"), F.least(y0, y1).alias(f"{prefix}miny"),
        F.greatest(x0, x1).alias(f"{prefix}maxx"), F.greatest(y0, y1).alias(f"{prefix}maxy"))


def overlay(base: DataFrame, other: DataFrame, bands, size: int, method: str = "bilinear", cell: float | None = None) -> DataFrame:
    """``bands`` of ``other`` on the tile grids of ``base``, joined to its tiles.

    Both are wide tile rows with a ``transform`` (left, x size, 0, top, 0, y
    size) per scene; resolutions and origins may differ from scene to scene, and
    several scenes of ``other`` may lie over one of ``base`` (their cells are
    averaged by weight where they overlap).  Which tiles meet follows from the
    boxes alone; only arrays of tiles that meet anything are resampled, and only
    target cells are shuffled.  Tiles of ``base`` without any are left out.
    ``cell``: grid size of the box join, about the side of a usual tile.
    """
    # One row per scene of the base: the grid, and how far its tiles reach.
    boxes = _boxes(base, size, "b_", "scene")
    grids = boxes.groupBy("b_scene", "b_transform").agg(*[f(f"b_{n}").alias(f"b_{n}") for f, n in (
        (F.min, "minx"), (F.min, "miny"), (F.max, "maxx"), (F.max, "maxy"))])
    keyed = _boxes(other, size, "a_", "scene", "tx", "ty")
    if cell is None:
        cell = keyed.agg(F.avg(F.col("a_maxx") - F.col("a_minx"))).first()[0] or 1.0
    met = bbox_join(keyed, grids, cell)
    a, b = F.col("a_transform"), F.col("b_transform")

    def reach(axis, origin, step):
        return F.round(F.greatest(*[(F.col(f"b_{end}{axis}") - b[origin]) / b[step] for end in ("min", "max")]))

    relations = met.groupBy(F.col("a_scene").alias("scene"), F.col("a_tx").alias("tx"), F.col("a_ty").alias("ty")).agg(
        F.collect_list(relation(F.col("b_scene"), 0, b[1] / a[1], b[5] / a[5], (b[0] - a[0]) / a[1], (b[3] - a[3]) / a[5],
                                reach("x", 0, 1), reach("y", 3, 5))).alias("relations"))
    moved = regrid(other.join(relations, ["scene", "tx", "ty"]), bands, size, method)
    return base.join(moved.select(F.col("target").alias("scene"), "tx", "ty", *bands), ["scene", "tx", "ty"])
