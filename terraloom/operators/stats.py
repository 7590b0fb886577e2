"""Raster statistics: every one is a partial-then-final aggregation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from terraloom.functions import indices

SCENE = ("scene",)
PRIME = (1 << 31) - 1


def _summary(value: Column) -> list[Column]:
    return [
        F.count(value).alias("cells"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
    ]


def _by_band(px: DataFrame, bands, scene, summary) -> DataFrame:
    """Aggregate every band in one pass, then turn the few results into rows."""
    wide = px.groupBy(*scene).agg(*[F.struct(*summary(b)).alias(f"_{b}") for b in bands])
    rows = F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"_{b}.*")) for b in bands])
    return wide.select(*scene, F.inline(rows))


def bands(px: DataFrame, bands, scene=SCENE) -> DataFrame:
    """Minimum, maximum, mean and population deviation per scene and band."""
    return _by_band(px, bands, scene, lambda b: _summary(indices.known(F.col(b).cast("double"))))


def _tile_part(data: Column) -> Column:
    """Count, extremes, mean and squared deviations of the cells of one array."""
    kind = StructType([StructField("n", LongType()), *[StructField(k, DoubleType()) for k in ("low", "high", "mean", "m2")]])

    @F.arrow_udf(kind)
    def run(column: pa.Array) -> pa.Array:
        ends = column.offsets.to_numpy()
        rows = np.repeat(np.arange(len(column)), np.diff(ends))
        cells = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].astype(np.float64)
        held = ~np.isnan(cells)
        rows, cells = rows[held], cells[held]
        n = np.bincount(rows, minlength=len(column))
        low, high = np.full(len(column), np.inf), np.full(len(column), -np.inf)
        heads = np.flatnonzero(np.diff(rows, prepend=-1))
        if len(cells):
            low[rows[heads]], high[rows[heads]] = np.minimum.reduceat(cells, heads), np.maximum.reduceat(cells, heads)
        mean = np.bincount(rows, cells, len(column)) / np.maximum(n, 1)
        m2 = np.bincount(rows, (cells - mean[rows]) ** 2, len(column))
        empty = n == 0
        parts = [pa.array(n), *[pa.array(v, mask=empty) for v in (low, high, mean, m2)]]
        return pa.StructArray.from_arrays(parts, ["n", "low", "high", "mean", "m2"])

    return run(data)


def bands_of_tiles(tiles: DataFrame, bands, scene=SCENE) -> DataFrame:
    """``bands`` on tile rows: one partial result per array, so no cell is a row.

    NaN cells and missing bands are left out; deviations of tiles are merged by their means.
    """
    empty = F.array().cast("array<float>")
    parts = tiles.select(*scene, *[_tile_part(F.coalesce(F.col(b).cast("array<float>"), empty)).alias(b) for b in bands])

    def merged(b: str) -> list[Column]:
        n, mean, m2 = (F.col(f"{b}.{k}") for k in ("n", "mean", "m2"))
        count, total = F.sum(n), F.sum(n * mean)
        spread = (F.sum(m2) + F.sum(n * mean * mean) - total * total / count) / count
        return [count.alias("cells"), F.min(f"{b}.low").alias("min"), F.max(f"{b}.high").alias("max"),
                (total / count).alias("mean"), F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std")]

    return _by_band(parts, bands, scene, merged)


def whole(px: DataFrame, bands) -> DataFrame:
    """The same over all bands and scenes together."""
    values = F.array(*[indices.known(F.col(b).cast("double")) for b in bands])
    return px.select(F.explode(values).alias("value")).agg(*_summary(F.col("value")))


def thresholds(px: DataFrame, conditions: dict[str, Column], scene=()) -> DataFrame:
    """Count and percentage of cells for each named condition, in one pass."""
    out = [F.count(F.lit(1)).alias("cells")]
    for name, condition in conditions.items():
        held = indices.is_true(condition)
        out.append(F.count_if(held).alias(f"{name}_count"))
        out.append((F.avg(held.cast("int")) * 100).alias(f"{name}_pct"))
    return px.groupBy(*scene).agg(*out)


def classes(px: DataFrame, value: str = "class", labels: dict | None = None, scene=()) -> DataFrame:
    """Class histogram with percentages and labels."""
    labels = indices.CLASS_LABELS if labels is None else labels
    counts = px.groupBy(*scene, value).agg(F.count(F.lit(1)).alias("cells"))
    # The total comes from the counts, a row per class; the cells are read once.
    total = F.sum("cells").over(Window.partitionBy(*scene))
    names = F.create_map(*[F.lit(v) for pair in labels.items() for v in pair])
    return counts.select(
        *scene, value, F.try_element_at(names, F.col(value).cast("int")).alias("label"),
        "cells", (F.col("cells") / total * 100).alias("pct"),
    )


def histogram(px: DataFrame, value: str, low: float = -0.5, width: float = 1.0, bins: int = 256,
              scene=()) -> DataFrame:
    """Counts per bin; values outside the range are left out."""
    bin_ = F.floor((indices.known(F.col(value).cast("double")) - low) / width)
    return (
        px.select(*scene, bin_.cast("int").alias("bin"))
        .filter(F.col("bin").between(0, bins - 1))
        .groupBy(*scene, "bin")
        .agg(F.count(F.lit(1)).alias("cells"))
    )


def approx(px: DataFrame, value: str, step: int = 4, scene=SCENE) -> DataFrame:
    """Statistics over every ``step``-th row and column, as over an overview."""
    few = px.filter((F.col("x") % step == step // 2) & (F.col("y") % step == step // 2))
    return bands(few, [value], scene)


def quantiles(px: DataFrame, value: str, shares=(0.25, 0.5, 0.75), accuracy: int = 10000,
              scene=SCENE) -> DataFrame:
    cell = indices.known(F.col(value).cast("double")).cast(px.schema[value].dataType)
    return px.groupBy(*scene).agg(*[
        F.percentile_approx(cell, q, accuracy).alias(f"p{round(q * 100)}") for q in shares
    ])


def fingerprint(px: DataFrame, bands, scene=SCENE) -> DataFrame:
    """Order-free checksum per scene and band, to 1/1024 of a unit.

    Each cell is mixed with its place modulo a prime in whole numbers and the
    results are added, so equal rows do not cancel and any engine can repeat it.
    """
    def mixed(b):
        value = F.coalesce(F.floor(indices.known(F.col(b).cast("double")) * 1024 + 0.5), F.lit(-7)).cast("long")
        place = F.pmod(F.pmod(F.col("x").cast("long") * 31 + F.col("y").cast("long"), F.lit(PRIME)) * 48271, F.lit(PRIME))
        both = F.pmod((place + F.pmod(value, F.lit(PRIME))) * 69621, F.lit(PRIME))
        return F.pmod(both * both, F.lit(PRIME))

    return _by_band(px, bands, scene, lambda b: [
        F.pmod(F.sum(mixed(b).cast("decimal(20,0)")), F.lit((1 << 61) - 1).cast("decimal(20,0)")).cast("long").alias("checksum"),
        F.count(F.lit(1)).alias("cells"),
    ])
