"""Operator throughput on the scene, repeated side by side to a given size."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from terraloom.functions import indices, tilemath
from terraloom.operators import algebra, focal, halo, regrid, resample, sketches, stats, tiles, zones
from terraloom.plans import workflows
from terraloom.session import shared_folder, ship
from terraloom.suite import fixtures as fx

c = F.col
ACROSS, TILE = 16, 256


def prepare(spark, sf, cells):
    """Write the repeated scene once as pixel rows and once as wide tiles."""
    ship(spark)
    root = f"{shared_folder(spark)}/scale-{uuid.uuid4().hex}"
    px = fx.scene(spark, sf)
    size = px.agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h")).first()
    copies = -(-cells // (size["w"] * size["h"]))
    many = px.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        "scene", (c("x") + c("_copy") % ACROSS * size["w"]).cast("int").alias("x"),
        (c("y") + F.floor(c("_copy") / ACROSS) * size["h"]).cast("int").alias("y"),
        *[c(b).cast("float").alias(b) for b in fx.BANDS],
    ).repartition(32, F.floor(c("x") / TILE), F.floor(c("y") / TILE)).sortWithinPartitions("y", "x")
    many.write.parquet(f"{root}/pixels")
    pixels = spark.read.parquet(f"{root}/pixels")
    tiles.from_pixels(pixels, fx.BANDS, TILE).repartition(32).write.parquet(f"{root}/tiles")
    return pixels, spark.read.parquet(f"{root}/tiles")


def jobs(pixels, wide):
    """Name and frame of each measured operator."""
    long = tiles.by_band(wide.select("scene", "tx", "ty", "w", "h", "dsm"), ["dsm"])
    mask = wide.select("scene", F.lit("m").alias("band"), "tx", "ty", tilemath.mask(tilemath.ndvi(), 0.35).alias("data"))
    classes = wide.select("scene", F.lit("c").alias("band"), "tx", "ty", tilemath.landcover().alias("data"))
    seen = algebra.ndvi(pixels).withColumn("mask", indices.vegetation_mask(c("ndvi")))
    return {
        "r01_ndvi pixels": algebra.ndvi(pixels).select("x", "y", "ndvi"),
        "r01_ndvi tiles, arrow": wide.select(tilemath.ndvi().alias("ndvi")),
        "r01_ndvi tiles, sql": wide.select(indices.over_arrays(indices.ndvi, c("nir"), c("red")).alias("ndvi")),
        "a07_band_stats pixels": stats.bands(pixels, ["red", "green", "blue", "nir"]),
        "a07_band_stats tiles": stats.bands_of_tiles(wide, ["red", "green", "blue", "nir"]),
        "z01_horn_slope pixels": focal.slope(pixels.select("scene", "x", "y", "dsm"), "dsm"),
        "z01_horn_slope tiles": halo.slope(long, TILE),
        "z07_halo_mean tiles": halo.mean3(long, TILE),
        "z04_closing pixels": focal.closing(seen.select("scene", "x", "y", "mask"), "mask"),
        "z04_closing tiles": halo.closing(mask, TILE),
        "z05_clean_classes pixels": focal.clean_classes(algebra.landcover(algebra.ndsm(algebra.ndvi(pixels))).select("scene", "x", "y", "class")),
        "z05_clean_classes tiles": halo.clean_classes(classes, TILE),
        "z06_fill_holes tiles": halo.fill_holes(mask, TILE),
        "z08_resize pixels": resample.to_grid(pixels, ["dsm"], 1.5, 1.5, 10**6, 10**6),
        "z08_resize tiles": regrid.resize(wide, ["dsm"], TILE, 1.5, 1.5, 10**6, 10**6),
        "z09_average tiles": regrid.resize(wide, ["dsm"], TILE, 2.5, 2.5, 10**6, 10**6, "average"),
        "z10_pyramid tiles, 4 levels": regrid.pyramid(wide, ["red", "nir"], TILE, [2, 4, 8, 16], 10**6, 10**6),
        "x03_landcover pixels": workflows.landcover(pixels),
        "x03_landcover tiles": workflows.landcover_tiles(wide, TILE),
        "a14_sketch tiles": sketches.merge(wide.select("scene", sketches.sketch("dsm").alias("sketch")), ["scene"]),
        "zone columns, 4 bands": zones.zoned(wide, ["red", "green", "blue", "nir"]).select("scene", "red_low", "nir_high"),
        "z10_overview pixels": resample.overview(pixels, ["red", "nir"], 4, size=(10**6, 10**6)),
        "x01_vegetation pixels": workflows.vegetation(pixels),
        "x01_vegetation tiles": workflows.vegetation_tiles(wide, TILE),
    }


def throughput(spark, sf, cells, only=()):
    pixels, wide = prepare(spark, sf, cells)
    n = pixels.count()
    for name, df in jobs(pixels, wide).items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        yield f"{name:28s} {took:8.2f} s {n / took / 1e6:8.2f} M cells/s ({n} cells)"
