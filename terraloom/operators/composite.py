"""Composites of many survey dates over one area.

Tile rows of all surveys lie on one grid (see ``regrid.overlay`` otherwise) and
carry a date.  A tile's arrays stream through its group one after another, so
a stack may be as deep as it likes; the median, which needs all values of a
cell, cuts tiles into slabs of cells that follow the depth of the stack.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

HOW = ("latest", "earliest", "mean", "median", "count")
#: Values of a slab that a task holds at once.
SLAB = 1 << 22


def chosen(tiles: DataFrame, size: int, box=None, dates=None, date: str = "year") -> DataFrame:
    """Tiles of the surveys and the area asked for.

    ``box`` (minx, miny, maxx, maxy) in world units by the tiles' ``transform``,
    or in cells where they have none; ``dates`` are (first, last), both included.
    The date reaches the scan of a stored table.
    """
    if dates is not None:
        tiles = tiles.filter(F.col(date).between(*dates))
    if box is None:
        return tiles
    flat = F.array(*[F.lit(v) for v in (0.0, 1.0, 0.0, 0.0, 0.0, 1.0)])
    t = F.coalesce(F.col("transform"), flat) if "transform" in tiles.columns else flat

    def touches(axis, origin, step, low, high):
        a, b = t[origin] + F.col(axis) * size * t[step], t[origin] + (F.col(axis) + 1) * size * t[step]
        return (F.least(a, b) < high) & (F.greatest(a, b) > low)

    return tiles.filter(touches("tx", 0, 1, box[0], box[2]) & touches("ty", 3, 5, box[1], box[3]))


def composite(tiles: DataFrame, bands, size: int, how: str = "latest", date: str = "year", area=("tx", "ty"), cells: int = SLAB) -> DataFrame:
    """One tile per ``area`` key: ``<area>, w, h, n_dates, <bands>`` (float64).

    ``latest`` and ``earliest`` take, cell by cell and band by band, the value of
    the last or first date that has one (ties: the scene that sorts last or
    first); ``mean``, ``median`` and ``count`` are over all that have one.  A cell
    that no survey has is NaN (0 for ``count``); rows without a date count as
    the oldest.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}, not {how!r}")
    keys = list(area)
    order = F.struct(F.col(date), F.col("scene"))
    # The rank of a survey at its place: a whole number instead of a date of any type.
    rows = tiles.select(*keys, order.alias("_at"), *[F.col(b).cast("array<double>").alias(f"b{n}") for n, b in enumerate(bands)])
    if how == "median":
        return _median(rows, bands, size, keys, cells)
    schema = tiles.select(*keys).schema
    result, out = _result(schema, bands)

    def reduce(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, depth = len(bands), 0
        best = np.full((n, size * size), np.nan)
        weight = np.zeros((n, size * size))
        when: list[list] = []  # the distinct surveys seen, by number
        number = np.full((n, size * size), -1, np.int64)
        for batch in batches:
            stamps = batch.column("_at").to_pylist()
            columns = [batch.column(f"b{k}") for k in range(n)]
            for row, stamp in enumerate(stamps):
                depth += 1
                at = tuple((v is not None, v) for v in stamp.values())
                when.append(at)
                for k in range(n):
                    cell = columns[k][row].values
                    if cell is None:
                        continue
                    cell = cell.to_numpy(zero_copy_only=False)
                    valid = ~np.isnan(cell)
                    if how in ("mean", "count"):
                        best[k] = np.where(valid, np.where(weight[k] > 0, best[k], 0.0) + np.where(valid, cell, 0.0), best[k])
                        weight[k] += valid
                        continue
                    newer = _newer(when, number[k], at, how)
                    take = valid & newer
                    best[k][take], number[k][take] = cell[take], len(when) - 1
        if how == "mean":
            best = np.where(weight > 0, best / np.maximum(weight, 1), np.nan)
        if how == "count":
            best = weight
        row = [*[s.as_py() for s in key], size, size, depth, *best]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, result)], schema=result)

    return rows.groupBy(*keys).applyInArrow(reduce, out)


def _newer(when: list, number: np.ndarray, at: tuple, how: str) -> np.ndarray:
    """Where the survey ``at`` beats the one that the cell has."""
    held = np.unique(number)
    beats = np.array([h < 0 or ((at > when[h]) if how == "latest" else (at < when[h])) for h in held.tolist()])
    return beats[np.searchsorted(held, number)]


def _result(schema, bands):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = pa.schema([*to_arrow_schema(schema), ("w", pa.int32()), ("h", pa.int32()), ("n_dates", pa.int64()), *[(b, pa.list_(pa.float64())) for b in bands]])
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema], "w int, h int, n_dates bigint", *[f"`{b}` array<double>" for b in bands]])
    return arrow, ddl


def _median(rows: DataFrame, bands, size: int, keys: list[str], cells: int) -> DataFrame:
    """Slabs of cells as groups of their own, then the slabs of a tile side by side."""
    n = len(bands)
    deepest = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    slabs = min(size * size, max(1, -(-deepest * n * size * size // cells)))
    step = -(-size * size // slabs)
    parts = F.array(*[
        F.struct(F.lit(k).alias("_slab"), *[F.slice(f"b{b}", k * step + 1, step).alias(f"b{b}") for b in range(n)])
        for k in range(-(-size * size // step))])
    schema = rows.select(*keys).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    slab = pa.schema([*to_arrow_schema(schema), ("_slab", pa.int32()), ("n_dates", pa.int64()), *[(f"b{b}", pa.list_(pa.float64())) for b in range(n)]])
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema], "_slab int, n_dates bigint", *[f"b{b} array<double>" for b in range(n)]])

    def middle(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        width = min(step, size * size - key[-1].as_py() * step)
        for b in range(n):
            stack = np.full((table.num_rows, width), np.nan)
            for k, cell in enumerate(table.column(f"b{b}")):
                if cell.values is not None:
                    stack[k, : len(cell.values)] = cell.values.to_numpy(zero_copy_only=False)
            have = ~np.isnan(stack)
            some = have.any(axis=0)
            value = np.full(width, np.nan)
            if some.any():
                value[some] = np.nanmedian(stack[:, some], axis=0)
            out.append(value)
        row = [*[k.as_py() for k in key], table.num_rows, *out]
        return pa.table([pa.array([v], f.type) for v, f in zip(row, slab)], schema=slab)

    slabbed = rows.select(*keys, F.inline(parts)).groupBy(*keys, "_slab").applyInArrow(middle, ddl)
    gathered = slabbed.groupBy(*keys).agg(F.max("n_dates").alias("n_dates"), F.array_sort(F.collect_list(F.struct("_slab", *[f"b{b}" for b in range(n)]))).alias("_s"))
    return gathered.select(
        *keys, F.lit(size).alias("w"), F.lit(size).alias("h"), "n_dates", *[F.flatten(F.col(f"_s.b{k}")).alias(b) for k, b in enumerate(bands)])


def stack(px: DataFrame, band: str, dates, date: str = "year", keys=("x", "y")) -> DataFrame:
    """Pixel rows with one column per date: ``<band>_<date>``; several values of a cell and date give the greatest."""
    wide = px.groupBy(*keys).pivot(date, list(dates)).agg(F.max(band))
    return wide.withColumnsRenamed({str(d): f"{band}_{d}" for d in dates})


def by_date(px: DataFrame, value: Column, name: str, box=None, date: str = "year") -> DataFrame:
    """Cells and mean of an expression per date, inside a box of cells (minx, miny, maxx, maxy)."""
    from terraloom.operators.spatial import clip

    some = px if box is None else clip(px, box)
    return some.groupBy(date).agg(F.count(F.lit(1)).alias("cells"), F.avg(value).alias(name))
