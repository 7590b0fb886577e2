"""Raster workflows over aligned pixels (``red green blue nir dsm dem``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terraloom.functions import indices, tilemath
from terraloom.operators import algebra, focal, halo, regrid


def vegetation(px: DataFrame, height_tolerance: float = 3.5, max_height: float | None = None,
               ndvi_threshold: float = indices.VEGETATION_NDVI, use_height: bool = True,
               out: str = "vegetation", keep_steps: bool = False) -> DataFrame:
    """Vegetation above a height as 0/1: index, height, mask, closing."""
    df = algebra.ndsm(algebra.ndvi(px)) if use_height else algebra.ndvi(px)
    df = df.withColumn("mask", indices.vegetation_mask(F.col("ndvi"), ndvi_threshold))
    return _finish(df, height_tolerance, max_height, use_height, out, keep_steps)


def general(px: DataFrame, height_tolerance: float = 3.5, max_height: float | None = None,
            greater: bool = True, index_value: float = 0.3, mode: str = "ndvi",
            use_height: bool = True, out: str = "selected", keep_steps: bool = False) -> DataFrame:
    """Any index against a threshold, optionally limited by height."""
    if mode not in ("ndvi", "ndwi"):
        raise ValueError(f"mode must be 'ndvi' or 'ndwi', not {mode!r}")
    df = {"ndvi": algebra.ndvi, "ndwi": algebra.ndwi}[mode](px)
    df = algebra.ndsm(df) if use_height else df
    df = algebra.classify(df, mode, greater, index_value)
    return _finish(df, height_tolerance, max_height, use_height, out, keep_steps)


def _finish(df, low, high, use_height, out, keep_steps):
    """Only the columns asked for travel through the neighbourhood shuffle."""
    steps = [c for c in ("ndvi", "ndwi", "ndsm", "mask") if c in df.columns]
    carried = ["scene", "x", "y", *(steps if keep_steps else ["mask"] + (["ndsm"] if use_height else []))]
    df = df.select(*carried)
    if use_height:
        df = focal.select_by_height(df, "mask", low, high, out=out)
    else:
        df = df.withColumn(out, F.col("mask"))
    extra = steps if keep_steps else []
    return df.select("scene", "x", "y", *extra, F.col(out).cast("tinyint").alias(out))


def vegetation_tiles(wide: DataFrame, size: int, height_tolerance: float = 3.5,
                     max_height: float | None = None,
                     ndvi_threshold: float = indices.VEGETATION_NDVI) -> DataFrame:
    """The vegetation workflow on wide tiles.

    The mask is computed inside each row, so of all bands only one array is
    shuffled for the closing.  Returns long tiles with band ``vegetation``.
    """
    masked = wide.select(
        "scene", F.lit("vegetation").alias("band"), "tx", "ty",
        tilemath.vegetation(height_tolerance, max_height, ndvi_threshold).alias("data"),
    )
    return halo.closing(masked, size)


def vegetation_of_grids(imagery: DataFrame, heights: DataFrame, size: int, height_tolerance: float = 3.5,
                        max_height: float | None = None, ndvi_threshold: float = indices.VEGETATION_NDVI,
                        method: str = "bilinear", cell: float | None = None) -> DataFrame:
    """The vegetation workflow on imagery tiles and height tiles (``dsm``, ``dem``) of other grids.

    Both carry a ``transform`` per scene, as ``rasters.to_tiles`` gives it; the
    heights are resampled to each imagery scene's grid first.
    """
    both = regrid.overlay(imagery, heights, ["dsm", "dem"], size, method, cell)
    return vegetation_tiles(both, size, height_tolerance, max_height, ndvi_threshold)


def landcover(px: DataFrame, res_x: float = 1.0, res_y: float = 1.0, ndvi_threshold: float = 0.3,
              height_threshold: float = 3.5, max_height: float | None = 50.0, iterations: int = 2,
              slope_threshold: float = 5.0, use_height: bool = True) -> DataFrame:
    """Index, height, slope, classes and cleaned classes for every cell."""
    df = algebra.ndvi(px, zero="zero")
    df = algebra.ndsm(df) if use_height else df
    df = algebra.landcover(df, ndvi_threshold, height_threshold, max_height, use_height)
    carried = ["ndvi", "class"] + (["ndsm", "dem"] if use_height else [])
    df = df.select("scene", "x", "y", *carried)
    # Cleaning and slope read different columns: one halo, one shuffle for both.
    steps = [focal.clean_step(iterations=iterations)]
    if use_height:
        steps.append(focal.slope_step("dem", res_x, res_y))
    df = focal.in_blocks(df, 2 * iterations, *steps)
    return focal.classify_slope(df, slope_threshold).drop("dem") if use_height else df


def landcover_tiles(wide: DataFrame, size: int, res_x: float = 1.0, res_y: float = 1.0, ndvi_threshold: float = 0.3,
                    height_threshold: float = 3.5, max_height: float | None = 50.0, iterations: int = 2,
                    slope_threshold: float = 5.0) -> DataFrame:
    """``landcover`` on wide tiles: scene, tx, ty and arrays ndvi, ndsm, class, cleaned, slope, slope_class.

    Index, height and classes are worked out inside each row; cleaning and slope
    read different bands with different borders from one exchange.  Missing
    cells are NaN in every array.
    """
    pointed = wide.select(
        "scene", "tx", "ty", "dem", tilemath.ndvi(zero="zero").alias("ndvi"), tilemath.ndsm().alias("ndsm"),
        tilemath.landcover(ndvi_threshold, height_threshold, max_height).alias("class"))
    horn_width, horn = halo.slope_kernel(res_x, res_y)
    clean_width, clean = halo.clean_kernel(iterations)
    kernels = {
        "cleaned": (["class"], clean_width, clean), "slope": (["dem"], horn_width, horn),
        "slope_class": (["dem"], horn_width, lambda dem: (horn(dem) >= slope_threshold).astype(float)),
    }
    return halo.apply_many(pointed, kernels, size, carry=["ndvi", "ndsm", "class"])


def general_tiles(wide: DataFrame, size: int, height_tolerance: float = 3.5, max_height: float | None = None, greater: bool = True,
                  index_value: float = 0.3, mode: str = "ndvi", use_height: bool = True) -> DataFrame:
    """``general`` on wide tiles: long tiles with band ``selected``, 0 or 1, NaN where a band is missing."""
    if mode not in ("ndvi", "ndwi"):
        raise ValueError(f"mode must be 'ndvi' or 'ndwi', not {mode!r}")
    bands = ("nir", "red") if mode == "ndvi" else ("green", "nir")
    masked = wide.select("scene", F.lit("selected").alias("band"), "tx", "ty", tilemath.selected(
        *bands, index_value, greater, height_tolerance, max_height, use_height).alias("data"))
    return halo.closing(masked, size) if use_height else masked


def landcover_summary(cells: DataFrame) -> DataFrame:
    """The statistics of a land-cover run as one row."""
    c = F.col
    return cells.agg(
        F.count(F.lit(1)).alias("cells"),
        F.min("ndvi").alias("ndvi_min"), F.max("ndvi").alias("ndvi_max"),
        F.avg("ndvi").alias("ndvi_mean"), F.stddev_pop("ndvi").alias("ndvi_std"),
        F.count_if(c("ndvi") > 0.3).alias("vegetation"), F.count_if(c("ndvi") > 0.5).alias("healthy"),
        F.max("ndsm").alias("height_max"), F.avg("ndsm").alias("height_mean"),
        F.stddev_pop("ndsm").alias("height_std"),
        F.count_if(c("ndsm") > 3).alias("above_3m"), F.count_if(c("ndsm") > 10).alias("above_10m"),
        (F.avg((c("slope_class") == 0).cast("int")) * 100).alias("flat_pct"),
        F.count_if(c("class") != c("cleaned")).alias("changed"),
        *[F.count_if(c("cleaned") == k).alias(f"class_{k}") for k in range(4)],
    )
