"""Neighbourhood operators on whole tiles.

Each tile sends strips of its border to the eight neighbours, one shuffle
groups a tile with the strips meant for it (nine rows at most), and a small
numpy function works on the padded array.  Only the arrays a function needs
are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KEYS = ("scene", "band", "tx", "ty")
RESULT = pa.schema([
    ("scene", pa.string()), ("band", pa.string()), ("tx", pa.int32()), ("ty", pa.int32()),
    ("data", pa.list_(pa.float32())),
])


def _strip(dx: int, dy: int, size: int, width: int, data: str = "data") -> Column:
    """The part of ``data`` that the neighbour at (dx, dy) needs, row-major."""
    rows = {-1: (0, width), 0: (0, size), 1: (size - width, width)}[dy]
    first = {-1: 0, 0: 0, 1: size - width}[dx]
    count = size if dx == 0 else width
    if dx == 0:
        return F.slice(data, rows[0] * size + 1, rows[1] * size)
    return F.flatten(F.transform(
        F.sequence(F.lit(rows[0]), F.lit(rows[0] + rows[1] - 1)),
        lambda r: F.slice(data, r * size + first + 1, count),
    ))


def apply(tiles: DataFrame, width: int, fn, size: int) -> DataFrame:
    """Run ``fn(padded, valid) -> array`` on every tile with a border of ``width``.

    ``tiles`` is the long form ``(scene, band, tx, ty, data)`` of square tiles
    with ``size`` cells per side.  ``padded`` is float64 with NaN for absent
    cells (beyond the raster), ``valid`` marks the others.  The result is
    cropped back to the tile and absent cells stay NaN.
    """
    if not 0 < width <= size:
        raise ValueError("the border must be between 1 and the tile size")
    pieces = [
        F.struct(
            F.lit(-dx).alias("dx"), F.lit(-dy).alias("dy"),
            (F.col("tx") + dx).cast("int").alias("tx"), (F.col("ty") + dy).cast("int").alias("ty"),
            (F.col("data") if dx == dy == 0 else _strip(dx, dy, size, width)).alias("data"),
        )
        for dx in (-1, 0, 1) for dy in (-1, 0, 1)
    ]
    sent = tiles.select("scene", "band", F.inline(F.array(*pieces)))
    full = size + 2 * width
    span = {-1: slice(0, width), 0: slice(width, width + size), 1: slice(width + size, full)}

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        dx, dy = rows["dx"].to_numpy(), rows["dy"].to_numpy()
        if not ((dx == 0) & (dy == 0)).any():
            return RESULT.empty_table()
        data = rows["data"].combine_chunks()
        cells = data.values.to_numpy(zero_copy_only=False)
        ends = data.offsets.to_numpy()
        padded = np.full((full, full), np.nan)
        for i in range(len(dx)):
            part = padded[span[dy[i]], span[dx[i]]]
            part[:] = cells[ends[i]:ends[i + 1]].reshape(part.shape)
        valid = ~np.isnan(padded)
        done = np.where(valid, fn(padded, valid), np.nan)[width:width + size, width:width + size]
        flat = pa.array(done.astype(np.float32).ravel())
        # The key arrives as Arrow scalars, in the order of KEYS.
        return pa.table(
            [*[pa.array([k.as_py()], f.type) for k, f in zip(key, RESULT)],
             pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)],
            schema=RESULT,
        )

    return sent.groupBy(*KEYS).applyInArrow(
        run, "scene string, band string, tx int, ty int, data array<float>"
    )


def shifted(grid: np.ndarray, dy: int, dx: int, fill) -> np.ndarray:
    """``out[y, x] = grid[y + dy, x + dx]``, ``fill`` outside."""
    out = np.full_like(grid, fill)
    h, w = grid.shape
    out[max(0, -dy):h - max(0, dy), max(0, -dx):w - max(0, dx)] = \
        grid[max(0, dy):h - max(0, -dy), max(0, dx):w - max(0, -dx)]
    return out


def close_mask(mask: np.ndarray, valid: np.ndarray, element: str, iterations: int) -> np.ndarray:
    """Binary closing; absent cells are never set and count as 0."""
    steps = [(0, 1), (0, -1), (1, 0), (-1, 0)]
    if element == "square":
        steps += [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    for merge in (np.logical_or, np.logical_and):
        for _ in range(iterations):
            mask = merge.reduce([mask, *[shifted(mask, dy, dx, False) for dy, dx in steps]]) & valid
    return mask


def apply_many(wide: DataFrame, kernels: dict, size: int, carry=()) -> DataFrame:
    """Several kernels over several bands of wide tiles, with one border exchange.

    ``kernels``: result name -> (bands, width, ``fn(*padded) -> array``); each
    padded array has the kernel's own ``width`` around the tile, NaN for absent
    cells.  A band's strips are as wide as the widest kernel on it needs, and
    bands of ``carry`` come along without any.  One row per tile: scene, tx, ty,
    the carried bands and the results (NaN where a kernel's first band is).
    """
    reach: dict[str, int] = dict.fromkeys(carry, 0)
    for bands, width, _ in kernels.values():
        if not 0 <= width <= size:
            raise ValueError("a border must be between 0 and the tile size")
        for b in bands:
            reach[b] = max(reach.get(b, 0), width)
    cells = {b: f"b{n}" for n, b in enumerate(reach)}
    held = wide.select("scene", "tx", "ty", *[F.col(b).cast("array<double>").alias(n) for b, n in cells.items()])
    none = F.lit(None).cast("array<double>")

    def strip(b, dx, dy):
        if dx == dy == 0:
            return F.col(cells[b])
        return _strip(dx, dy, size, reach[b], cells[b]) if reach[b] else none

    pieces = [
        F.struct(
            F.lit(-dx).alias("dx"), F.lit(-dy).alias("dy"), (F.col("tx") + dx).cast("int").alias("tx"), (F.col("ty") + dy).cast("int").alias("ty"),
            *[strip(b, dx, dy).alias(n) for b, n in cells.items()])
        for dx in (-1, 0, 1) for dy in (-1, 0, 1)
    ]
    sent = held.select("scene", F.inline(F.array(*pieces)))
    result = pa.schema([("scene", pa.string()), ("tx", pa.int32()), ("ty", pa.int32()), *[(n, pa.list_(pa.float64())) for n in (*carry, *kernels)]])

    def padded(rows: pa.Table, dx, dy, b):
        width = reach[b]
        full = size + 2 * width
        span = {-1: slice(0, width), 0: slice(width, width + size), 1: slice(width + size, full)}
        out, data = np.full((full, full), np.nan), rows[cells[b]].combine_chunks()
        there, ends, values = data.is_valid().to_numpy(zero_copy_only=False), data.offsets.to_numpy(), data.values.to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(there):
            part = out[span[dy[i]], span[dx[i]]]
            part[:] = values[ends[i]:ends[i + 1]].reshape(part.shape)
        return out

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        dx, dy = rows["dx"].to_numpy(), rows["dy"].to_numpy()
        if not ((dx == 0) & (dy == 0)).any():
            return result.empty_table()
        grids = {b: padded(rows, dx, dy, b) for b in cells}

        def around(b, width):
            cut = reach[b] - width
            return grids[b][cut:cut + size + 2 * width, cut:cut + size + 2 * width]

        out = [around(b, 0).ravel() for b in carry]
        for bands, width, fn in kernels.values():
            own = [around(b, width) for b in bands]
            done = np.where(np.isnan(own[0]), np.nan, fn(*own))
            out.append(done[width:width + size, width:width + size].ravel())
        return pa.table([pa.array([v], f.type) for v, f in zip([*[k.as_py() for k in key], *out], result)], schema=result)

    return sent.groupBy("scene", "tx", "ty").applyInArrow(
        run, "scene string, tx int, ty int, " + ", ".join(f"{n} array<double>" for n in (*carry, *kernels)))


def closing_kernel(element: str = "square", iterations: int = 1):
    """(width, fn) of the binary closing of 0/1 cells."""

    def close(padded, valid=None):
        valid = ~np.isnan(padded) if valid is None else valid
        return close_mask(padded == 1, valid, element, iterations).astype(np.float32)

    return 2 * iterations, close


def closing(tiles: DataFrame, size: int, element: str = "square", iterations: int = 1) -> DataFrame:
    """Binary closing of 0/1 tiles."""
    width, close = closing_kernel(element, iterations)
    return apply(tiles, width, close, size)


def clean_kernel(iterations: int = 2, element: str = "cross", classes=None):
    """(width, fn) of the closing per class; the higher class wins."""

    def clean(padded, valid=None):
        valid = ~np.isnan(padded) if valid is None else valid
        out = padded.copy()
        for code in sorted(np.unique(padded[padded > 0]) if classes is None else classes):
            out[close_mask(padded == code, valid, element, iterations)] = code
        return out

    return 2 * iterations, clean


def clean_classes(tiles: DataFrame, size: int, iterations: int = 2, element: str = "cross",
                  classes=None) -> DataFrame:
    """Per-class closing of a class tile, for ``classes`` or every positive code; the higher class wins."""
    width, clean = clean_kernel(iterations, element, classes)
    return apply(tiles, width, clean, size)


def fill_holes(tiles: DataFrame, size: int, distance: int = 10, smoothing: int = 1,
               hole: float = 0.0) -> DataFrame:
    """Fill holes by inverse distance from the nearest value of each quadrant.

    A cell equal to ``hole`` is filled when another value lies within ``distance`` cells; ``smoothing`` 3x3 mean passes then run over
    the filled cells.  Cells out of reach keep ``hole``.
    """

    def fill(padded, valid):
        have = valid & (padded != hole)
        wanted = valid & ~have
        if not wanted.any() or not have.any():
            return np.where(wanted, hole, padded)
        height, limit = padded.shape[0], distance * distance
        row = np.arange(height, dtype=np.int32)[:, None]
        far = np.int32(10 * (height + distance))
        values = np.where(have, padded, 0.0)
        # Row of the closest value at or above / at or below, per column.
        above = np.maximum.accumulate(np.where(have, row, -far), axis=0)
        below = np.minimum.accumulate(np.where(have, row, far)[::-1], axis=0)[::-1]
        over, under = shifted(above, -1, 0, -far), shifted(below, 1, 0, far)
        weight, total = np.zeros(padded.shape), np.zeros(padded.shape)
        # Half-open quadrants: every direction belongs to exactly one.
        for source, columns in (
            (over, range(0, distance + 1)), (below, range(1, distance + 1)),
            (under, range(-distance, 1)), (above, range(-distance, 0)),
        ):
            best = np.full(padded.shape, limit + 1, dtype=np.int32)
            at_row, step = np.zeros_like(best), np.zeros_like(best)
            for dx in columns:
                at = shifted(source, 0, dx, far)
                d2 = (at - row) ** 2 + dx * dx
                nearer = d2 < best
                for target, new in ((best, d2), (at_row, at), (step, dx)):
                    np.copyto(target, new, where=nearer)
            y, x = np.nonzero(wanted & (best <= limit))
            pull = 1.0 / np.sqrt(best[y, x])
            weight[y, x] += pull
            total[y, x] += values[at_row[y, x], x + step[y, x]] * pull
        filled = weight > 0
        out = np.where(wanted, hole, padded)
        out[filled] = total[filled] / weight[filled]
        present = have | filled
        for _ in range(smoothing):
            summed, count = _around(out, present)
            out = np.where(filled, summed / np.maximum(count, 1), out)
        return out

    # Smoothing needs the filled neighbours, which need their own sources.
    return apply(tiles, distance + smoothing, fill, size)


def _around(grid: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the existing cells of each 3x3 neighbourhood."""
    near = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    values, ones = np.where(have, grid, 0.0), have.astype(np.float64)
    return (
        sum(shifted(values, dy, dx, 0.0) for dy, dx in near),
        sum(shifted(ones, dy, dx, 0.0) for dy, dx in near),
    )


def mean3(tiles: DataFrame, size: int) -> DataFrame:
    """3x3 mean over the cells that exist."""

    def mean(padded, valid):
        total, count = _around(padded, valid)
        return total / np.maximum(count, 1)

    return apply(tiles, 1, mean, size)


def slope_kernel(res_x: float = 1.0, res_y: float = 1.0, fmt: str = "degrees"):
    """(width, fn) of the Horn slope."""
    if fmt not in ("degrees", "percent", "rise_run"):
        raise ValueError(f"unknown slope format {fmt!r}")

    def side(grid, dy, dx):
        moved = shifted(grid, dy, dx, np.nan)
        return np.where(np.isnan(moved), grid, moved)

    def horn(padded, valid=None):
        left, right = side(padded, 0, -1), side(padded, 0, 1)
        across, smooth = right - left, left + 2 * padded + right
        gx = (side(across, -1, 0) + 2 * across + side(across, 1, 0)) / (8 * res_x)
        gy = (side(smooth, 1, 0) - side(smooth, -1, 0)) / (8 * res_y)
        run = np.sqrt(gx * gx + gy * gy)
        return {"degrees": np.degrees(np.arctan(run)), "percent": run * 100, "rise_run": run}[fmt]

    return 1, horn


def slope(tiles: DataFrame, size: int, res_x: float = 1.0, res_y: float = 1.0, fmt: str = "degrees") -> DataFrame:
    """Horn slope of elevation tiles, absent neighbours replaced like in ``focal.slope``."""
    width, horn = slope_kernel(res_x, res_y, fmt)
    return apply(tiles, width, horn, size)
