"""Resampling, overviews and pixel coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.operators.joins import lookup
from terraloom.operators.tiles import without_nan

SCENE = ("scene",)


def _targets(axis: str, ratio: float, shift: float, reach: float) -> Column:
    """Target cells whose centre lies within ``reach`` source cells of a source centre.

    A target ``t`` sits at source position ``(t + 0.5) * ratio - 0.5 + shift``.
    """
    at = F.col(axis) - shift + 0.5
    low = F.floor((at - reach) / ratio - 0.5) + 1
    high = F.ceil((at + reach) / ratio - 0.5) - 1
    return F.when(low <= high, F.sequence(low, high))


def to_grid(px: DataFrame, bands, ratio_x: float, ratio_y: float, width: int, height: int,
            method: str = "bilinear", shift_x: float = 0.0, shift_y: float = 0.0,
            scene=SCENE) -> DataFrame:
    """Resample pixel rows to another grid.

    ``ratio`` is target cell size over source cell size and ``shift`` the offset
    of the target's origin from the source's in source cells; the target has
    ``width`` x ``height`` cells.  Methods: ``nearest``, ``bilinear``
    (edges take the nearest cells, absent cells are left out of the mean) and
    ``average`` (mean of the cells whose centre falls inside, for shrinking).

    Each source cell is sent to the targets it touches and partial sums meet in
    one aggregation: no join, and the combine runs before the shuffle.
    """
    keys, px = [F.col(s) for s in scene], without_nan(px, bands)
    if method == "average":
        cells = px.withColumns({
            "_X": F.floor((F.col("x") + 0.5 - shift_x) / ratio_x),
            "_Y": F.floor((F.col("y") + 0.5 - shift_y) / ratio_y),
        }).withColumn("_w", F.lit(1.0))
    elif method == "nearest":
        # The source cell that holds the target's centre.
        def holds(axis, ratio, shift):
            at = F.col(axis) - shift
            low, high = F.ceil(at / ratio - 0.5), F.ceil((at + 1) / ratio - 0.5) - 1
            return F.explode(F.when(low <= high, F.sequence(low, high)))

        cells = px.withColumn("_X", holds("x", ratio_x, shift_x)).withColumn(
            "_Y", holds("y", ratio_y, shift_y)
        )
    elif method == "bilinear":
        cells = px.withColumn("_X", F.explode(_targets("x", ratio_x, shift_x, 1.0))).withColumn(
            "_Y", F.explode(_targets("y", ratio_y, shift_y, 1.0))
        )

        def near(axis, target, ratio, shift):
            return 1.0 - F.abs((F.col(target) + 0.5) * ratio - 0.5 + shift - F.col(axis))

        cells = cells.withColumn(
            "_w", near("x", "_X", ratio_x, shift_x) * near("y", "_Y", ratio_y, shift_y)
        ).filter(F.col("_w") > 1e-9)
    else:
        raise ValueError(f"unknown method {method!r}")
    cells = cells.filter(F.col("_X").between(0, width - 1) & F.col("_Y").between(0, height - 1))
    if method == "nearest":
        return cells.select(
            *keys, F.col("_X").cast("int").alias("x"), F.col("_Y").cast("int").alias("y"), *bands
        )
    sums = [
        (F.sum(F.col("_w") * F.col(b)) / F.sum(F.when(F.col(b).isNotNull(), F.col("_w")))).alias(b)
        for b in bands
    ]
    return cells.groupBy(
        *keys, F.col("_X").cast("int").alias("x"), F.col("_Y").cast("int").alias("y")
    ).agg(*sums)


def to_resolution(px: DataFrame, bands, res: float, target: float, width: int, height: int,
                  method: str = "bilinear", scene=SCENE) -> DataFrame:
    """Resample a ``width`` x ``height`` raster from ``res`` to ``target`` units."""
    ratio = target / res
    columns, rows = max(1, round(width / ratio)), max(1, round(height / ratio))
    return to_grid(px, bands, ratio, ratio, columns, rows, method, scene=scene)


def extent(px: DataFrame, scene=SCENE) -> DataFrame:
    """Width and height per scene, counted from cell 0."""
    return px.groupBy(*scene).agg(
        (F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height")
    )


def factor_for(overviews: list[int], level: int) -> int:
    """Overview factor of a level; level 0 and rasters without overviews are full."""
    return overviews[min(level - 1, len(overviews) - 1)] if level > 0 and overviews else 1


def overview(px: DataFrame, bands, factor: int, method: str = "average",
             size: tuple[int, int] | None = None, scene=SCENE) -> DataFrame:
    """Shrink by a whole factor; partial cells at the far edges are dropped.

    ``size`` is the raster's (width, height); without it the extent is
    aggregated per scene.  ``nearest`` is a filter and needs no shuffle.
    Missing cells, null or NaN, are left out of a mean.
    """
    px = without_nan(px, bands)
    if size is None:
        px = lookup(px, extent(px, scene), list(scene))
        width, height = F.col("width"), F.col("height")
    else:
        width, height = F.lit(size[0]), F.lit(size[1])
    x, y = F.floor(F.col("x") / factor), F.floor(F.col("y") / factor)
    whole = px.filter((x < F.floor(width / factor)) & (y < F.floor(height / factor)))
    x, y = x.cast("int").alias("x"), y.cast("int").alias("y")
    if method == "nearest":
        middle = factor // 2
        return whole.filter(
            (F.col("x") % factor == middle) & (F.col("y") % factor == middle)
        ).select(*scene, x, y, *bands)
    if method != "average":
        raise ValueError(f"unknown method {method!r}")
    return whole.groupBy(*scene, x, y).agg(*[F.avg(b).alias(b) for b in bands])


def compare_levels(px: DataFrame, overviews: list[int], levels: int = 4, bands: int = 4,
                   cell_bytes: int = 4, scene=SCENE) -> DataFrame:
    """Size of each overview level and its share of the full raster.

    One aggregation over the pixels; the levels follow from the extent.
    """
    steps = F.array(*[
        F.struct(F.lit(n).alias("level"), F.lit(factor_for(overviews, n)).alias("factor"))
        for n in range(levels)
    ])
    sized = extent(px, scene).select(*scene, "width", "height", F.inline(steps))
    full = F.col("width") * F.col("height")
    columns, rows = F.floor(F.col("width") / F.col("factor")), F.floor(F.col("height") / F.col("factor"))
    return sized.select(
        *scene, "level", "factor", columns.alias("level_width"), rows.alias("level_height"),
        (columns * rows * bands).alias("pixels"),
        (columns * rows * bands * cell_bytes / 1048576).alias("size_mb"),
        (columns * rows / full * 100).alias("reduction_pct"),
    )


def world(px: DataFrame, left, top, res_x, res_y) -> DataFrame:
    """Add the world coordinates of each cell centre (north is up); numbers, or columns of the scene."""
    return px.withColumns({
        "world_x": left + (F.col("x") + 0.5) * res_x,
        "world_y": top - (F.col("y") + 0.5) * res_y,
    })


def world_of_scene(px: DataFrame) -> DataFrame:
    """``world`` by each row's own ``transform`` (left, x size, 0, top, 0, y size), rotated ones included."""
    t, x, y = F.col("transform"), F.col("x") + 0.5, F.col("y") + 0.5
    return px.withColumns({"world_x": t[0] + x * t[1] + y * t[2], "world_y": t[3] + x * t[4] + y * t[5]})
