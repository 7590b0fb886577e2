"""Pointwise raster arithmetic on whole tile arrays.

The formulas are those of ``functions.indices``, vectorised over an Arrow
batch: the values of all tiles of a batch are one numpy array, so the cost per
tile is nil.  Missing cells are NaN and stay NaN; masks are 0 or 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from terraloom.functions import indices


def _cells(column: pa.Array, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The cells of a band laid out row by row on the lengths of the batch; NaN where the band has none."""
    own = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(column.offsets.to_numpy()))
    begin = column.offsets.to_numpy()[:-1]
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    if (own == lengths).all():
        if own.sum() == len(values):
            return values
        rows = np.repeat(begin - starts, own)
        return values[rows + np.arange(len(rows))]
    out = np.full(int(lengths.sum()), np.nan)
    step = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
    out[np.repeat(starts, own) + step] = values[np.repeat(begin, own) + step]
    return out


def pointwise(fn, *arrays: str | Column) -> Column:
    """``fn(*float64 arrays) -> array`` over the cells of tile arrays.

    Rows stand alone: a tile whose band is null or shorter has NaN for the
    cells it lacks, and a tile without any band gives null.
    """

    @F.arrow_udf("array<float>")
    def run(*columns: pa.Array) -> pa.Array:
        there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
        lengths = np.max([np.where(v, np.diff(c.offsets.to_numpy()), 0) for v, c in zip(there, columns)], axis=0)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        values = [_cells(c, ends[:-1], lengths) for c in columns]
        with np.errstate(divide="ignore", invalid="ignore"):
            out = fn(*values).astype(np.float32)
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(out), mask=pa.array(~there.any(axis=0)))

    return run(*arrays)


def difference(a: np.ndarray, b: np.ndarray, zero: str = "null") -> np.ndarray:
    total = a + b
    if zero == "null":
        return np.where(total != 0, (a - b) / total, np.nan)
    return np.clip((a - b) / np.where(total == 0, 1.0, total), -1.0, 1.0)


def height(dsm: np.ndarray, dem: np.ndarray) -> np.ndarray:
    return np.maximum(dsm - dem, 0.0)


def ndvi(nir="nir", red="red", zero: str = "null") -> Column:
    return pointwise(lambda n, r: difference(n, r, zero), nir, red)


def ndwi(green="green", nir="nir", zero: str = "null") -> Column:
    return pointwise(lambda g, n: difference(g, n, zero), green, nir)


def ndsm(dsm="dsm", dem="dem") -> Column:
    return pointwise(height, dsm, dem)


def mask(index: str | Column, value: float, greater: bool = True) -> Column:
    return pointwise(lambda v: v > value if greater else v < value, index)


def vegetation(low: float, high: float | None = None, value: float = indices.VEGETATION_NDVI,
               nir="nir", red="red", dsm="dsm", dem="dem") -> Column:
    """Cells above the index value within the height range; NaN where a band is missing."""

    def held(n, r, s, d):
        tall = height(s, d)
        inside = (difference(n, r) > value) & (tall >= low)
        inside = inside if high is None else inside & (tall <= high)
        return np.where(np.isnan(n + r + s + d), np.nan, inside)

    return pointwise(held, nir, red, dsm, dem)


def landcover(index_value: float = 0.3, height_value: float = 3.5, max_height: float | None = None,
              nir="nir", red="red", dsm="dsm", dem="dem") -> Column:
    """Class codes; see ``indices.landcover``."""

    def classes(n, r, s, d):
        v, tall = difference(n, r, "zero"), height(s, d)
        green, high = v > index_value, tall > height_value
        tree = green & high if max_height is None else green & high & (tall <= max_height)
        out = np.where(tree, 3.0, np.where(green & (tall <= height_value), 2.0, np.where(
            (v <= index_value) & high, 1.0, 0.0)))
        return np.where(np.isnan(n + r + s + d), np.nan, out)

    return pointwise(classes, nir, red, dsm, dem)


def passing(a: str | Column, b: str | Column, value: float, greater: bool = True) -> Column:
    """The normalised difference where it is beyond ``value``, NaN elsewhere."""

    def held(x, y):
        v = difference(x, y)
        return np.where(v > value if greater else v < value, v, np.nan)

    return pointwise(held, a, b)


def heights_between(dsm: str | Column, dem: str | Column, low: float, high: float | None = None) -> Column:
    """Height above ground within the range, both ends inclusive; NaN elsewhere."""

    def held(s, d):
        h = height(s, d)
        inside = h >= low if high is None else (h >= low) & (h <= high)
        return np.where(inside, h, np.nan)

    return pointwise(held, dsm, dem)


def with_numbers(fn, arrays, numbers) -> Column:
    """``fn(*float64 arrays, *float64 numbers) -> array``: ``pointwise`` with a number per tile next to its cells."""
    n = len(arrays)

    @F.arrow_udf("array<float>")
    def run(*columns: pa.Array) -> pa.Array:
        cells, single = columns[:n], columns[n:]
        there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in cells])
        lengths = np.max([np.where(v, np.diff(c.offsets.to_numpy()), 0) for v, c in zip(there, cells)], axis=0)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        values = [_cells(c, ends[:-1], lengths) for c in cells]
        more = [np.repeat(c.cast(pa.float64()).to_numpy(zero_copy_only=False), lengths) for c in single]
        with np.errstate(divide="ignore", invalid="ignore"):
            out = fn(*values, *more).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out), mask=pa.array(~there.any(axis=0)))

    return run(*arrays, *numbers)


def stretch(value: str | Column, low: str | Column, high: str | Column) -> Column:
    """(value - low) / (high - low) within 0 and 1; NaN where the span is 0."""
    return with_numbers(lambda v, a, b: np.where(b != a, np.clip((v - a) / np.where(b != a, b - a, 1.0), 0.0, 1.0), np.nan), [value], [low, high])


def hsv(part: int, red: str | Column, green: str | Column, blue: str | Column, gain: str | Column) -> Column:
    """Hue (0), saturation (1) or value (2) of ``indices.hsv``, the bands times ``gain`` cut to whole numbers first."""

    def worked(r, g, b, k):
        r, g, b = np.floor(r * k), np.floor(g * k), np.floor(b * k)
        top, low = np.maximum(np.maximum(r, g), b), np.minimum(np.minimum(r, g), b)
        span = top - low
        half_up = lambda v: np.floor(v + 0.5)
        if part == 2:
            return half_up(top)
        if part == 1:
            return half_up(np.where(top == 0, np.where(np.isnan(top), np.nan, 0.0), 255 * span / np.where(top == 0, 1.0, top)))
        safe = np.where(span == 0, 1.0, span)
        degrees = np.where(span == 0, 0.0, np.where(top == r, 60 * (g - b) / safe, np.where(
            top == g, 120 + 60 * (b - r) / safe, 240 + 60 * (r - g) / safe)))
        degrees = np.where(degrees < 0, degrees + 360, degrees)
        return np.where(np.isnan(span), np.nan, half_up(degrees / 2) % 180)

    return with_numbers(worked, [red, green, blue], [gain])


def selected(a: str | Column, b: str | Column, value: float, greater: bool = True, low: float = 0.0, high: float | None = None,
             use_height: bool = True, dsm="dsm", dem="dem") -> Column:
    """0/1 where the normalised difference is beyond ``value``, within a height range if asked for."""

    def held(x, y, *heights):
        v = difference(x, y)
        inside = v > value if greater else v < value
        missing = np.isnan(x + y)
        if heights:
            tall = height(*heights)
            inside = inside & (tall >= low) & (True if high is None else tall <= high)
            missing = missing | np.isnan(tall)
        return np.where(missing, np.nan, inside)

    return pointwise(held, a, b, *((dsm, dem) if use_height else ()))
