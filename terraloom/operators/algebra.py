"""Map algebra over pixel rows: each function adds one column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terraloom.functions import indices
from terraloom.operators.joins import lookup
from terraloom.operators.tiles import without_nan

c = F.col


def cast_bands(px: DataFrame, bands) -> DataFrame:
    return px.withColumns({b: c(b).cast("float") for b in bands})


def ndvi(px: DataFrame, zero: str = "null", out: str = "ndvi") -> DataFrame:
    return px.withColumn(out, indices.ndvi(c("nir"), c("red"), zero))


def ndwi(px: DataFrame, zero: str = "null", out: str = "ndwi") -> DataFrame:
    return px.withColumn(out, indices.ndwi(c("green"), c("nir"), zero))


def brightness(px: DataFrame, out: str = "brightness") -> DataFrame:
    return px.withColumn(out, indices.brightness(c("red"), c("green"), c("blue")))


def urban_index(px: DataFrame, out: str = "urban_index") -> DataFrame:
    return px.withColumn(out, indices.urban_index(c("ndvi"), c("brightness")))


def urban_mask(px: DataFrame, out: str = "urban") -> DataFrame:
    return px.withColumn(out, indices.urban_mask(c("ndvi"), c("brightness")))


def ndsm(px: DataFrame, out: str = "ndsm") -> DataFrame:
    return px.withColumn(out, indices.height_above_ground(c("dsm"), c("dem")))


def classify(px: DataFrame, index: str = "ndvi", greater: bool = True, value: float = 0.3,
             out: str = "mask") -> DataFrame:
    return px.withColumn(out, indices.threshold_mask(c(index), value, greater))


def landcover(px: DataFrame, ndvi_threshold: float = 0.3, height_threshold: float = 3.5,
              max_height: float | None = None, use_height: bool = True,
              out: str = "class") -> DataFrame:
    height = c("ndsm") if use_height else None
    return px.withColumn(
        out, indices.landcover(c("ndvi"), height, ndvi_threshold, height_threshold, max_height)
    )


def hsv(px: DataFrame, scene=("scene",)) -> DataFrame:
    """Add ``hue, saturation, value`` on the 8-bit scale.

    A scene whose largest band value does not exceed 1 is scaled by 255 first;
    both cases are truncated to whole numbers.
    """
    px = without_nan(px, ("red", "green", "blue"))
    top = px.groupBy(*scene).agg(F.max(F.greatest("red", "green", "blue")).alias("_top"))
    scaled = lookup(px, top, list(scene))
    gain = F.when(c("_top") > 1, 1.0).otherwise(255.0)
    h, s, v = indices.hsv(*[F.floor(c(b) * gain) for b in ("red", "green", "blue")])
    return scaled.withColumns({"hue": h, "saturation": s, "value": v}).drop("_top")


def stretch(px: DataFrame, scene=("scene",)) -> DataFrame:
    """Add ``red_01, green_01, blue_01``: min-max stretch over the cells that the three bands have."""
    px = without_nan(px, ("red", "green", "blue"))
    span = px.groupBy(*scene).agg(
        F.min(F.least("red", "green", "blue")).alias("_low"),
        F.max(F.greatest("red", "green", "blue")).alias("_high"),
    )
    return lookup(px, span, list(scene)).withColumns({
        f"{b}_01": indices.stretch(c(b), c("_low"), c("_high")) for b in ("red", "green", "blue")
    }).drop("_low", "_high")


def changed_tiles(a: DataFrame, b: DataFrame, value: str = "class", keys=("scene", "tx", "ty")) -> DataFrame:
    """``changed`` on tile rows: arrays meet on tile keys, and a tile gives two numbers.

    Cells that either raster lacks (NaN or beyond its array) are left out.
    """
    pairs = a.select(*keys, c(value).cast("array<double>").alias("_a")).join(b.select(*keys, c(value).cast("array<double>").alias("_b")), list(keys))
    both = F.filter(F.zip_with("_a", "_b", lambda x, y: F.when(~F.isnan(x) & ~F.isnan(y), x != y)), lambda v: v.isNotNull())
    counts = pairs.select(F.size(both).alias("_cells"), F.size(F.filter(both, lambda v: v)).alias("_changed"))
    return counts.agg(F.coalesce(F.sum("_changed"), F.lit(0)).alias("changed"), F.coalesce(F.sum("_cells"), F.lit(0)).alias("cells")).withColumn(
        "changed_pct", c("changed") * 100.0 / F.nullif("cells", F.lit(0)))


def changed(a: DataFrame, b: DataFrame, value: str = "class", keys=("scene", "x", "y")) -> DataFrame:
    """Number and share of cells whose value differs between two rasters."""
    pairs = a.select(*keys, c(value).alias("_a")).join(b.select(*keys, c(value).alias("_b")), list(keys))
    return pairs.agg(
        F.count_if(c("_a") != c("_b")).alias("changed"),
        F.count(F.lit(1)).alias("cells"),
        (F.avg((c("_a") != c("_b")).cast("int")) * 100).alias("changed_pct"),
    )
