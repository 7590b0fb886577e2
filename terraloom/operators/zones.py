"""Zone maps: what is known of a tile without its cells.

``zoned`` adds flat columns per band (count, minimum, maximum, mean and squared
deviations), so that a stored tile table answers statistics and stretches from
a few numbers per tile, and a threshold becomes a predicate on columns that
Parquet can skip row groups and pages by.  Indices and heights get bounds from
the bounds of their bands; a tile is left out only if no cell of it can pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions import indices, tilemath
from terraloom.operators.stats import _by_band, _tile_part

KEPT = {"n": "n", "low": "low", "high": "high", "mean": "mean", "m2": "m2"}


def zoned(tiles: DataFrame, bands) -> DataFrame:
    """``tiles`` with ``<band>_n, _low, _high, _mean, _m2``; a band without cells has 0 and nulls."""
    empty = F.array().cast("array<float>")
    df = tiles.withColumns({f"_zone_{b}": _tile_part(F.coalesce(F.col(b).cast("array<float>"), empty)) for b in bands})
    flat = {f"{b}_{name}": F.col(f"_zone_{b}.{field}") for b in bands for name, field in KEPT.items()}
    return df.withColumns(flat).drop(*[f"_zone_{b}" for b in bands])


def store(tiles: DataFrame, bands, folder: str) -> None:
    """Zoned tile rows as Parquet, neighbours of a scene together, small row groups and pages so that tiles can be skipped."""
    (
        zoned(tiles, bands).repartition("scene", F.floor(F.col("ty") / 8), F.floor(F.col("tx") / 8)).sortWithinPartitions("scene", "ty", "tx")
        .write.mode("overwrite").option("parquet.block.size", 32 << 20).option("parquet.page.size", 256 << 10).parquet(folder)
    )


def bands(zones: DataFrame, bands, scene=("scene",)) -> DataFrame:
    """``stats.bands`` from the zone columns; the cells are not read."""

    def merged(b: str) -> list[Column]:
        n, mean, m2 = (F.col(f"{b}_{k}") for k in ("n", "mean", "m2"))
        count, total = F.sum(n), F.sum(n * mean)
        spread = (F.sum(m2) + F.sum(n * mean * mean) - total * total / count) / count
        return [count.alias("cells"), F.min(f"{b}_low").alias("min"), F.max(f"{b}_high").alias("max"),
                (total / count).alias("mean"), F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std")]

    return _by_band(zones, bands, scene, merged)


class Bounds:
    """The least and greatest value that a cell of the tile can have; null where nothing is known."""

    def __init__(self, low: Column, high: Column):
        self.low, self.high = low, high

    def may_be_above(self, value: float) -> Column:
        return F.coalesce(self.high > value, F.lit(True))

    def may_be_below(self, value: float) -> Column:
        return F.coalesce(self.low < value, F.lit(True))

    def may_lie_between(self, low: float, high: float | None = None) -> Column:
        reach = F.coalesce(self.high >= low, F.lit(True))
        return reach if high is None else reach & F.coalesce(self.low <= high, F.lit(True))


def band(name: str) -> Bounds:
    return Bounds(F.col(f"{name}_low"), F.col(f"{name}_high"))


def difference(a: str, b: str) -> Bounds:
    """(a - b) / (a + b), which rises with a and falls with b while neither is negative."""
    p, q = band(a), band(b)
    known = (p.low >= 0) & (q.low >= 0)

    def at(x, y):
        return F.when(known & (x + y > 0), (x - y) / (x + y))

    return Bounds(at(p.low, q.high), at(p.high, q.low))


def height(dsm: str = "dsm", dem: str = "dem") -> Bounds:
    """max(dsm - dem, 0)."""
    p, q = band(dsm), band(dem)
    zero = F.lit(0.0)
    return Bounds(F.greatest(p.low - q.high, zero), F.greatest(p.high - q.low, zero))


def has_cells(*names: str) -> Column:
    """Whether the tile has any cell of each band."""
    out = F.lit(True)
    for n in names:
        out = out & (F.col(f"{n}_n") > 0)
    return out


def index_filter(tiles: DataFrame, a: str, b: str, value: float, greater: bool = True, out: str = "index") -> DataFrame:
    """Tiles with the normalised difference of two bands, its cells beyond ``value`` NaN.

    Tiles that cannot have a passing cell are skipped by their zone columns,
    those whose cells all failed are dropped.
    """
    bounds = difference(a, b)
    some = tiles.filter(has_cells(a, b) & (bounds.may_be_above(value) if greater else bounds.may_be_below(value)))
    return _with_cells(some.withColumn(out, tilemath.passing(a, b, value, greater)), out)


def height_filter(tiles: DataFrame, low: float, high: float | None = None, dsm: str = "dsm", dem: str = "dem", out: str = "height") -> DataFrame:
    """Tiles with the height above ground, cells outside of ``low`` to ``high`` NaN; tiles are skipped as above."""
    some = tiles.filter(has_cells(dsm, dem) & height(dsm, dem).may_lie_between(low, high))
    return _with_cells(some.withColumn(out, tilemath.heights_between(dsm, dem, low, high)), out)


def _with_cells(tiles: DataFrame, out: str) -> DataFrame:
    return tiles.filter(F.exists(out, lambda v: ~F.isnan(v)))


def spans(zones: DataFrame, bands, scene=("scene",)) -> DataFrame:
    """Least and greatest value of all bands together, one row per scene."""
    low, high = [F.col(f"{b}_low") for b in bands], [F.col(f"{b}_high") for b in bands]
    one = len(bands) == 1
    return zones.groupBy(*scene).agg(F.min(low[0] if one else F.least(*low)).alias("low"), F.max(high[0] if one else F.greatest(*high)).alias("high"))


RGB = ("red", "green", "blue")


def stretch(tiles: DataFrame, bands=RGB, scene=("scene",)) -> DataFrame:
    """``algebra.stretch`` on zoned tiles: the cells are read once, the span comes from the zone columns.

    The span counts every cell of a band, also where another band has none.
    """
    met = tiles.join(spans(tiles, bands, scene), list(scene))
    return met.withColumns({f"{b}_01": tilemath.stretch(b, "low", "high") for b in bands}).drop("low", "high")


def hsv(tiles: DataFrame, scene=("scene",)) -> DataFrame:
    """``algebra.hsv`` on zoned tiles; whether a scene's values end at 1 comes from the zone columns."""
    top = spans(tiles, RGB, scene).select(*scene, F.when(F.col("high") > 1, 1.0).otherwise(255.0).alias("_gain"))
    met = tiles.join(top, list(scene))
    return met.withColumns({name: tilemath.hsv(n, *RGB, "_gain") for n, name in enumerate(("hue", "saturation", "value"))}).drop("_gain")
