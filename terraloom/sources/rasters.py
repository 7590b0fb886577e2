"""Raster files: header inventory and block ingest, many files per job."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions.indices import known
from terraloom.functions import files, tiff
from terraloom.sources.listing import tasks_of

HEADER = (
    "path string, file_length bigint, driver string, width int, height int, band_count int, dtype string, "
    "compression string, interleave string, tiled string, block_x int, block_y int, predictor int, "
    "photometric int, nodata double, epsg int, transform array<double>, overview_widths array<int>, "
    "metadata string, byte_order string, offsets array<bigint>, counts array<bigint>, "
    "overviews array<struct<width: int, height: int, band_count: int, dtype: string, compression: string, "
    "interleave: string, tiled: string, block_x: int, block_y: int, predictor: int, offsets: array<bigint>, "
    "counts: array<bigint>>>, error string"
)

BLOCK = (
    "scene string, block int, first_band int, x0 int, y0 int, w int, h int, "
    "planes array<array<float>>, transform array<double>, error string"
)

# The same two schemas as the tasks build them.
HEADER_ARROW = pa.schema([
    ("path", pa.string()), ("file_length", pa.int64()), ("driver", pa.string()), ("width", pa.int32()),
    ("height", pa.int32()), ("band_count", pa.int32()), ("dtype", pa.string()), ("compression", pa.string()),
    ("interleave", pa.string()), ("tiled", pa.string()), ("block_x", pa.int32()), ("block_y", pa.int32()),
    ("predictor", pa.int32()), ("photometric", pa.int32()), ("nodata", pa.float64()), ("epsg", pa.int32()),
    ("transform", pa.list_(pa.float64())), ("overview_widths", pa.list_(pa.int32())), ("metadata", pa.string()),
    ("byte_order", pa.string()), ("offsets", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("overviews", pa.list_(pa.struct([
        ("width", pa.int32()), ("height", pa.int32()), ("band_count", pa.int32()), ("dtype", pa.string()),
        ("compression", pa.string()), ("interleave", pa.string()), ("tiled", pa.string()), ("block_x", pa.int32()),
        ("block_y", pa.int32()), ("predictor", pa.int32()), ("offsets", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]))),
    ("error", pa.string()),
])
# What a level of a file has of its own; the image itself is level 0.
LEVEL = ("width", "height", "band_count", "dtype", "compression", "interleave", "tiled", "block_x", "block_y", "predictor",
         "offsets", "counts")
BLOCK_ARROW = pa.schema([
    ("scene", pa.string()), ("block", pa.int32()), ("first_band", pa.int32()), ("x0", pa.int32()), ("y0", pa.int32()),
    ("w", pa.int32()), ("h", pa.int32()), ("planes", pa.list_(pa.list_(pa.float32()))),
    ("transform", pa.list_(pa.float64())), ("error", pa.string()),
])
FILES_PER_BATCH = 64
# Blocks of a file that are read together, and stored bytes a task reads on average.
RUN, TASK_BYTES = 64, 64 * 1024 * 1024
BATCH_BYTES = 32 * 1024 * 1024


def headers(listing: DataFrame, tasks: int | None = None) -> DataFrame:
    """Read the header of every listed file (``path`` and ``length``).

    Only the directories are read, not the pixels.  A file that cannot be read
    becomes a row with ``error`` set.
    """
    names = HEADER_ARROW.names

    def one(path, length):
        row = dict.fromkeys(names)
        row.update(path=path, file_length=length)
        try:
            with files.open_file(path) as file:
                row.update(tiff.header(file))
        except Exception as failure:  # one bad file must not end the job
            row["error"] = f"{type(failure).__name__}: {failure}"
        return row

    def read(batches):
        for batch in batches:
            listed = batch.to_pylist()
            # Block indexes can be long: a few files per batch.
            for at in range(0, len(listed), FILES_PER_BATCH):
                rows = [one(f["path"], f["length"]) for f in listed[at:at + FILES_PER_BATCH]]
                yield pa.RecordBatch.from_pylist(rows, schema=HEADER_ARROW)

    spread = listing.select("path", "length").repartition(tasks or tasks_of(listing.sparkSession), "path")
    return spread.mapInArrow(read, HEADER)


def good(headers_df: DataFrame) -> DataFrame:
    return headers_df.filter(F.col("error").isNull())


def ingestable() -> Column:
    """Headers whose pixels ``blocks`` can decode."""
    return F.coalesce(
        F.col("compression").isin("NONE", "DEFLATE") & F.col("predictor").isin(1, 2)
        & F.col("dtype").isin("uint8", "uint16", "uint32", "int8", "int16", "int32", "float32", "float64"),
        F.lit(False),
    )


def rejects(headers_df: DataFrame) -> DataFrame:
    """Files that stay out of the ingest, with the reason."""
    reason = F.coalesce("error", F.concat(F.lit("not decodable: "), "compression", F.lit(", "), "dtype"))
    return headers_df.filter(~ingestable() | F.col("error").isNotNull()).select("path", reason.alias("reason"))


def _windows(headers_df: DataFrame, level: int, box) -> DataFrame:
    """Files with the layout of the level, its transform, and the cells of it that are wanted (``win_*``)."""
    c = F.col
    good_files = headers_df.filter(c("error").isNull() & ingestable())
    image = F.struct(*LEVEL)
    stored = F.filter("overviews", lambda o: F.size(o.offsets) > 0)
    chosen = image if level <= 0 else F.when(
        F.coalesce(F.size(stored), F.lit(0)) > 0, F.get(stored, F.least(F.lit(level), F.size(stored)) - 1)).otherwise(image)
    flat = F.array(*[F.lit(v) for v in (0.0, 1.0, 0.0, 0.0, 0.0, 1.0)])
    files_ = good_files.withColumns({"_l": chosen, "_t": F.coalesce("transform", flat)}).withColumn(
        "factor", F.greatest(F.lit(1), F.bround(c("width") / c("_l.width")).cast("int")))
    names = ("minx", "miny", "maxx", "maxy")
    edges = [F.lit(None)] * 4 if box is None else [F.lit(float(v)) if isinstance(v, (int, float)) else (c(v) if isinstance(v, str) else v) for v in box]
    files_ = files_.select(
        "path", "byte_order", "nodata", "factor", *[c(f"_l.{n}").alias(n) for n in LEVEL],
        F.floor(c("width") / c("factor")).cast("int").alias("_w"), F.floor(c("height") / c("factor")).cast("int").alias("_h"),
        F.array(c("_t")[0], c("_t")[1] * c("factor"), c("_t")[2] * c("factor"), c("_t")[3], c("_t")[4] * c("factor"), c("_t")[5] * c("factor")).alias("transform"),
        *[e.cast("double").alias(n) for e, n in zip(edges, names)])
    if box is None:
        first_x, last_x, first_y, last_y = F.lit(0), c("_w") - 1, F.lit(0), c("_h") - 1
    else:
        t = c("transform")
        told = F.raise_error(F.concat(F.lit("no window of a rotated raster: "), c("path")))
        upright = F.when((t[2] != 0) | (t[4] != 0), told.cast("double")).otherwise(0.0)

        def span(low, high, origin, step, size):
            a, b = (c(low) - origin) / step + upright, (c(high) - origin) / step
            first, last = F.ceil(F.least(a, b) - 0.5), F.floor(F.greatest(a, b) - 0.5)
            return F.least(size, F.greatest(F.lit(0), first)), F.greatest(F.lit(-1), F.least(size - 1, last))

        first_x, last_x = span("minx", "maxx", t[0], t[1], c("_w"))
        first_y, last_y = span("miny", "maxy", t[3], t[5], c("_h"))
    files_ = files_.withColumns({n: v.cast("int") for n, v in zip(("win_x0", "win_x1", "win_y0", "win_y1"), (first_x, last_x, first_y, last_y))})
    files_ = files_.filter((c("win_x0") <= c("win_x1")) & (c("win_y0") <= c("win_y1")))
    return files_


def read_plan(headers_df: DataFrame, level: int = 0, box=None, bands=None) -> DataFrame:
    """One row per stored block that a read needs; nothing but the headers is looked at.

    ``level``: 0 is the image, n the n-th stored overview, the last one if there
    are fewer, the image if there is none.  A level is ``factor`` times coarser,
    has the whole cells only, and its own ``transform``.  ``box`` (minx, miny,
    maxx, maxy; numbers or columns of the headers) keeps the blocks with a cell
    whose centre lies inside, by each file's own transform; files apart from it
    have no rows.  ``bands`` (from 1) leaves out the planes of others where a
    file stores them apart.
    """
    c = F.col
    files_ = _windows(headers_df, level, box)
    across, down = F.ceil(c("width") / c("block_x")).cast("int"), F.ceil(c("height") / c("block_y")).cast("int")
    apart = c("interleave") == "BAND"
    wanted = F.sequence(F.lit(1), c("band_count")) if bands is None else F.filter(F.array(*map(F.lit, bands)), lambda b: b <= c("band_count"))

    def along(first, last, step):
        return F.sequence(F.floor(first / step).cast("int"), F.floor(last / step).cast("int"))

    def entry(plane, by, bx):
        n = F.when(apart, plane - 1).otherwise(0) * c("across") * c("down") + by * c("across") + bx
        return F.struct(n.cast("int").alias("block"), plane.cast("int").alias("first_band"), (bx * c("block_x")).cast("int").alias("x0"),
                        (by * c("block_y")).cast("int").alias("y0"), F.get("offsets", n).alias("offset"), F.get("counts", n).alias("size"))

    each = F.flatten(F.transform(F.when(apart, wanted).otherwise(F.array(F.lit(1))), lambda plane: F.flatten(F.transform(
        along(c("win_y0"), c("win_y1"), c("block_y")), lambda by: F.transform(along(c("win_x0"), c("win_x1"), c("block_x")), lambda bx: entry(plane, by, bx))))))
    return files_.withColumns({"across": across, "down": down}).withColumn("_b", F.explode(each)).select(
        "path", "dtype", "byte_order", "compression", "predictor", "nodata", "width", "height", "block_x", "block_y", "tiled", "factor",
        "transform", F.when(apart, 1).otherwise(c("band_count")).alias("planes"), "_b.*", "win_x0", "win_x1", "win_y0", "win_y1")


def level_grid(headers_df: DataFrame, level: int = 0) -> DataFrame:
    """``path, factor, width, height, transform`` of a level as ``read_plan`` reads it."""
    return _windows(headers_df, level, None).select(
        "path", "factor", (F.col("win_x1") + 1).alias("width"), (F.col("win_y1") + 1).alias("height"), "transform")


def blocks(headers_df: DataFrame, tasks: int | None = None, level: int = 0, box=None, bands=None) -> DataFrame:
    """One row per block of ``read_plan``, its planes decoded to float32 and cut to the window.

    Runs of neighbouring blocks of a file are read by one task, several runs
    by several, so one huge file is read by many tasks; their number follows the
    stored bytes, which are summed first (``headers_df`` should be a stored
    table) unless ``tasks`` is given.  ``x0`` and ``y0`` count cells of the level,
    ``transform`` is the level's.  Blocks that fail to decode carry ``error``;
    cells equal to the file's nodata value become NaN.
    """
    plan = read_plan(headers_df, level, box, bands)
    if tasks is None:
        total = plan.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
        least = min(tasks_of(headers_df.sparkSession), -(-total["n"] // RUN) or 1)
        tasks = max(1, least, -(-(total["bytes"] or 0) // TASK_BYTES))

    def read(batches):
        ready, held = [], 0
        for batch in batches:
            for path, group in batch.to_pandas().groupby("path", sort=False):
                for row in _file_blocks(path, group.sort_values("offset")):
                    ready.append(row)
                    held += sum(p.nbytes for p in row["planes"] or ())
                    # Decoded blocks are large: hand them on by size, not by count.
                    if held >= BATCH_BYTES:
                        yield _batch(ready)
                        ready, held = [], 0
        if ready:
            yield _batch(ready)

    run = F.floor(F.col("block") / RUN)
    return plan.repartition(tasks, "path", run).mapInArrow(read, BLOCK)


def _file_blocks(path, group):
    """Decode the wanted blocks of one file; a failure becomes a row with ``error``."""
    def failed(r, failure):
        return {"scene": path, "block": r.block, "first_band": r.first_band, "x0": r.x0, "y0": r.y0, "w": 0, "h": 0,
                "planes": None, "transform": r.transform, "error": f"{type(failure).__name__}: {failure}"}

    try:
        file = files.open_file(path)
    except Exception as failure:
        yield from (failed(r, failure) for r in group.itertuples())
        return
    with file:
        for r in group.itertuples():
            try:
                row = _block(path, r, file)
            except Exception as failure:
                row = failed(r, failure)
            yield row


def _block(path, r, file):
    # Tiles are stored whole; the last strip may be shorter.
    rows = r.block_y if r.tiled == "YES" else min(r.block_y, r.height - r.y0)
    # The part of the block inside the window, whose edges count cells of the level.
    left, right = max(r.win_x0 - r.x0, 0), min(r.win_x1 + 1 - r.x0, r.block_x)
    top, bottom = max(r.win_y0 - r.y0, 0), min(r.win_y1 + 1 - r.y0, rows)
    place = {"scene": path, "block": r.block, "first_band": r.first_band, "x0": r.x0 + left, "y0": r.y0 + top, "w": right - left,
             "h": bottom - top, "transform": r.transform, "error": None}
    if r.offset == 0 or r.size == 0:  # a sparse block: nothing stored, all cells missing
        return {**place, "planes": [np.full(place["w"] * place["h"], np.nan, np.float32)] * int(r.planes)}
    file.seek(r.offset)
    data = tiff.decode(file.read(r.size), r.dtype, r.byte_order, r.compression, r.predictor,
                       rows, r.block_x, r.planes)
    data = data[:, top:bottom, left:right]
    if r.nodata is not None and r.nodata == r.nodata:
        data[data == np.float32(r.nodata)] = np.nan
    return {**place, "planes": [p.ravel() for p in data]}


def _batch(rows) -> pa.RecordBatch:
    """Rows as Arrow, the cells of all planes as one flat buffer."""
    planes = [p for r in rows for p in r["planes"] or ()]
    inner = np.cumsum([0, *[len(p) for p in planes]])
    outer = np.cumsum([0, *[len(r["planes"] or ()) for r in rows]])
    cells = np.concatenate(planes) if planes else np.zeros(0, np.float32)
    nested = pa.ListArray.from_arrays(
        pa.array(outer, pa.int32()), pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(cells)))
    columns = [
        nested if f.name == "planes" else pa.array([r[f.name] for r in rows], f.type) for f in BLOCK_ARROW
    ]
    return pa.RecordBatch.from_arrays(columns, schema=BLOCK_ARROW)


def failed(blocks_df: DataFrame) -> DataFrame:
    """Blocks that could not be decoded, with the reason."""
    return blocks_df.filter(F.col("error").isNotNull()).select("scene", "block", "first_band", "x0", "y0", "error")


def _decoded(blocks_df: DataFrame, skip_failed: bool) -> DataFrame:
    """Blocks with their cells; one that failed ends the job unless it may be left out."""
    if skip_failed:
        return blocks_df.filter(F.col("error").isNull())
    told = F.raise_error(F.concat(F.lit("block "), "block", F.lit(" of "), "scene", F.lit(": "), "error"))
    return blocks_df.withColumn("planes", F.when(F.col("error").isNull(), F.col("planes")).otherwise(told))


def to_pixels(blocks_df: DataFrame, bands, skip_failed: bool = False) -> DataFrame:
    """Pixel rows of pixel-interleaved blocks: band ``n`` becomes column ``bands[n]``.

    Narrow: every block carries all bands of its cells.  A failed block raises
    an error, or with ``skip_failed`` its cells are absent (see ``failed``).
    """
    ok = _decoded(blocks_df, skip_failed)
    none = F.array().cast("array<float>")
    planes = [F.coalesce(F.get("planes", F.lit(n)), none).alias(b) for n, b in enumerate(bands)]
    cells = ok.select("scene", "x0", "y0", "w", *planes).select(
        "scene", "x0", "y0", "w", F.posexplode(F.arrays_zip(*bands)).alias("_i", "_cell")
    )
    return cells.select(
        "scene",
        (F.col("x0") + F.col("_i") % F.col("w")).cast("int").alias("x"),
        (F.col("y0") + F.floor(F.col("_i") / F.col("w"))).cast("int").alias("y"),
        *[known(F.col(f"_cell.{b}")).alias(b) for b in bands],
    )


def to_tiles(blocks_df: DataFrame, bands, size: int = 256, skip_failed: bool = False) -> DataFrame:
    """Square tile rows ``(scene, tx, ty, w, h, transform, <bands>)`` of blocks of any shape and either interleave.

    Each block is cut along the tile grid, the parts of a tile that a task has
    travel as one row, and one shuffle brings those of a tile together: a group
    holds the cells of one tile.  Cells that no block has are NaN; a band that no
    block of the tile has is null.  Failed blocks as in ``to_pixels``.
    """
    part = pa.schema([
        ("scene", pa.string()), ("tx", pa.int32()), ("ty", pa.int32()), ("transform", pa.list_(pa.float64())),
        ("places", pa.list_(pa.int32())), ("cells", pa.list_(pa.float32()))])

    def cut(batches):
        for batch in batches:
            column = {n: batch.column(n).to_pylist() for n in ("scene", "first_band", "x0", "y0", "w", "h", "transform")}
            planes = batch.column("planes")
            outer, inner = planes.offsets.to_numpy(), planes.values.offsets.to_numpy()
            cells = planes.values.values.to_numpy(zero_copy_only=False)
            parts: dict[tuple, list] = {}
            for k in range(batch.num_rows):
                scene, x0, y0, w, h = (column[n][k] for n in ("scene", "x0", "y0", "w", "h"))
                for n, plane in enumerate(range(outer[k], outer[k + 1])):
                    grid = cells[inner[plane]:inner[plane + 1]].reshape(h, w)
                    band = column["first_band"][k] + n
                    if band > len(bands):
                        continue
                    for ty in range(y0 // size, (y0 + h - 1) // size + 1):
                        top, bottom = max(y0, ty * size), min(y0 + h, (ty + 1) * size)
                        for tx in range(x0 // size, (x0 + w - 1) // size + 1):
                            left, right = max(x0, tx * size), min(x0 + w, (tx + 1) * size)
                            held = parts.setdefault((scene, tx, ty), [column["transform"][k], [], []])
                            held[1] += (band, left - tx * size, top - ty * size, right - left, bottom - top)
                            held[2].append(grid[top - y0:bottom - y0, left - x0:right - x0].ravel())
            rows = [{"scene": scene, "tx": tx, "ty": ty, "transform": t, "places": places, "cells": np.concatenate(data)}
                    for (scene, tx, ty), (t, places, data) in parts.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in part], schema=part)

    result = pa.schema([*list(part)[:3], ("w", pa.int32()), ("h", pa.int32()), part.field("transform"),
                        *[(b, pa.list_(pa.float32())) for b in bands]])

    def assemble(key: tuple, rows: pa.Table) -> pa.Table:
        grids: dict[int, np.ndarray] = {}
        for places, cells in zip(rows["places"].to_pylist(), rows["cells"]):
            cells, at = cells.values.to_numpy(zero_copy_only=False), 0
            for band, x, y, w, h in zip(*[iter(places)] * 5):
                grid = grids.setdefault(band, np.full((size, size), np.nan, np.float32))
                grid[y:y + h, x:x + w] = cells[at:at + w * h].reshape(h, w)
                at += w * h
        row = [*[k.as_py() for k in key], size, size, rows["transform"][0].as_py(),
               *[grids[n + 1].ravel() if n + 1 in grids else None for n in range(len(bands))]]
        return pa.table([pa.array([v], f.type) for v, f in zip(row, result)], schema=result)

    cut_rows = _decoded(blocks_df, skip_failed).mapInArrow(
        cut, "scene string, tx int, ty int, transform array<double>, places array<int>, cells array<float>")
    return cut_rows.groupBy("scene", "tx", "ty").applyInArrow(
        assemble, "scene string, tx int, ty int, w int, h int, transform array<double>, " + ", ".join(f"{b} array<float>" for b in bands))


def to_long(blocks_df: DataFrame, skip_failed: bool = False) -> DataFrame:
    """Long rows ``(scene, band, x0, y0, w, h, data)`` for either interleave; failed blocks as in ``to_pixels``."""
    return _decoded(blocks_df, skip_failed).select(
        "scene", "x0", "y0", "w", "h", "first_band", F.posexplode("planes").alias("_i", "data")
    ).select("scene", (F.col("first_band") + F.col("_i")).alias("band"), "x0", "y0", "w", "h", "data")
