"""Queries on zone maps, sketches, composites of surveys and several kernels in one exchange."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.operators import composite, sketches, tiles, zones
from terraloom.plans import workflows
from terraloom.suite import fixtures as fx
from terraloom.suite.files import folder
from terraloom.suite.grids import FOUR, NDSM, NDWI, S, band_stats_sql
from terraloom.suite.neighbours import GENERAL, LANDRUN
from terraloom.suite.registry import query, rounded, six

c = F.col


def stored(spark, sf, bands=fx.BANDS):
    """The scene as a stored table with zone columns."""
    root = folder(spark)
    zones.store(fx.tiles(spark, sf), bands, root)
    return spark.read.parquet(root)


def cells(wide, *bands):
    """Pixel rows of the cells that the first band has."""
    px = tiles.to_pixels(wide.select("scene", "tx", "ty", F.lit(fx.SIZE).alias("w"), *bands), list(bands), fx.SIZE)
    return px.filter(c(bands[0]).isNotNull())


# ---- zone maps ------------------------------------------------------------

@query("a07_zone_stats", S + band_stats_sql("scene", FOUR))
def zone_stats(spark, sf):
    return rounded(zones.bands(stored(spark, sf), FOUR).drop("scene"), "mean", "std")


@query("w05_zone_filter", S + f"SELECT x, y, CAST({NDWI} AS FLOAT) AS ndwi FROM scene WHERE {NDWI} < -0.4")
def zone_index(spark, sf):
    """Tiles that cannot have a passing cell are not looked at."""
    out = zones.index_filter(stored(spark, sf), "green", "nir", -0.4, greater=False, out="ndwi")
    return cells(out, "ndwi").select("x", "y", "ndwi")


@query("w06_zone_filter", S + f"SELECT x, y, CAST({NDSM} AS FLOAT) AS ndsm FROM scene WHERE {NDSM} >= 8.25 AND {NDSM} <= 30")
def zone_height(spark, sf):
    out = zones.height_filter(stored(spark, sf), 8.25, 30.0, out="ndsm")
    return cells(out, "ndsm").select("x", "y", "ndsm")


@query("r12_zone_stretch", S + """, m AS (SELECT MIN(LEAST(red, green, blue)) AS lo, MAX(GREATEST(red, green, blue)) AS hi FROM scene)
    SELECT x, y, CAST((red - lo) / (hi - lo) AS FLOAT) AS red_01, CAST((green - lo) / (hi - lo) AS FLOAT) AS green_01, CAST((blue - lo) / (hi - lo) AS FLOAT) AS blue_01 FROM scene, m""")
def zone_stretch(spark, sf):
    px = cells(zones.stretch(stored(spark, sf)), "red_01", "green_01", "blue_01")
    return px.select("x", "y", "red_01", "green_01", "blue_01")


def hsv_sql(scale):
    bands = ", ".join(f"FLOOR({b} * {scale}) AS {b[0]}" for b in ("red", "green", "blue"))
    return f""", e AS (SELECT x, y, {bands} FROM scene), t AS (SELECT *, GREATEST(r, g, b) AS top, GREATEST(r, g, b) - LEAST(r, g, b) AS span FROM e),
    d AS (SELECT *, CASE WHEN span = 0 THEN 0 WHEN top = r THEN 60 * (g - b) / span WHEN top = g THEN 120 + 60 * (b - r) / span ELSE 240 + 60 * (r - g) / span END AS deg FROM t)
    SELECT x, y, CAST(ROUND(CASE WHEN deg < 0 THEN deg + 360 ELSE deg END / 2) AS INT) % 180 AS hue,
    CAST(CASE WHEN top = 0 THEN 0 ELSE ROUND(255 * span / top) END AS INT) AS saturation, CAST(top AS INT) AS value FROM d"""


def hsv_cells(spark, sf, wide):
    px = cells(zones.hsv(wide), "hue", "saturation", "value")
    return px.select("x", "y", *[c(n).cast("int").alias(n) for n in ("hue", "saturation", "value")])


@query("r11_zone_hsv", S + hsv_sql("1.0::DOUBLE"))
def zone_hsv(spark, sf):
    return hsv_cells(spark, sf, stored(spark, sf))


@query("r11_zone_hsv_unit", S.replace("scene AS (", "whole AS (").rstrip() + """,
    scene AS (SELECT x, y, red / 256 AS red, green / 256 AS green, blue / 256 AS blue FROM whole)
    """ + hsv_sql("255.0::DOUBLE"))
def zone_hsv_unit(spark, sf):
    """A scene with values up to 1 is brought to the 8-bit scale first."""
    root = folder(spark)
    unit = fx.tiles(spark, sf).withColumns({b: F.transform(b, lambda v: v / 256) for b in zones.RGB})
    zones.store(unit, zones.RGB, root)
    return hsv_cells(spark, sf, spark.read.parquet(root))


# ---- sketches -------------------------------------------------------------

@query("a14_sketch_quantiles", S + """, q AS (SELECT y // 40 AS strip, quantile_disc(dsm, [0.25, 0.5, 0.75]) AS q, COUNT(*) AS n, MIN(dsm) AS low, MAX(dsm) AS high FROM scene GROUP BY 1)
    SELECT CAST(strip AS INT) AS strip, n, ROUND(low, 3) AS low, ROUND(high, 3) AS high, ROUND(q[1], 3) AS p25, ROUND(q[2], 3) AS p50, ROUND(q[3], 3) AS p75, TRUE AS within FROM q""")
def sketch_quantiles(spark, sf):
    """Sketches of all tiles are stored and merged per strip of five tile rows; few enough cells there to be exact."""
    root = folder(spark)
    fx.tiles(spark, sf).select(F.floor(c("ty") / 5).cast("int").alias("strip"), sketches.sketch("dsm", 4096).alias("sketch")).write.parquet(root)
    merged = sketches.merge(spark.read.parquet(root), ["strip"], points=4096).withColumn("q", sketches.quantiles("sketch", (0.25, 0.5, 0.75)))
    number = lambda v, name: F.round(v, 3).alias(name)
    return merged.select(
        "strip", c("sketch.n").alias("n"), number(c("sketch.low"), "low"), number(c("sketch.high"), "high"),
        *[number(c("q")[k], f"p{p}") for k, p in enumerate((25, 50, 75))], (sketches.rank_error() <= 0.01).alias("within"))


@query("a15_histogram_tiles", S + "SELECT CAST(nir AS INT) AS bin, COUNT(*) AS cells FROM scene WHERE nir >= 0 AND nir < 256 GROUP BY 1")
def histogram_tiles(spark, sf):
    made = fx.tiles(spark, sf).select("scene", sketches.histogram("nir").alias("histogram"))
    return sketches.merge_histograms(made, []).select("bin", "cells")


# ---- surveys of several dates ---------------------------------------------

def dated(spark, sf):
    """Three surveys of the scene; the second lacks cells on diagonals, the third has a third of its rows only."""
    t = fx.tiles(spark, sf).select("scene", "tx", "ty", "w", "h", "red", "nir")
    x = lambda i: c("tx") * fx.SIZE + i % fx.SIZE
    y = lambda i: c("ty") * fx.SIZE + F.floor(i / fx.SIZE)
    nan = F.lit(float("nan"))
    second = {b: F.transform(b, lambda v, i: F.when((x(i) + 2 * y(i)) % 5 == 0, nan).otherwise(v * 3 % 256)) for b in ("red", "nir")}
    third = {b: F.transform(b, lambda v, i: F.when(y(i) % 3 != 0, nan).otherwise((v + 7) % 256)) for b in ("red", "nir")}
    years = [t.withColumn("year", F.lit("2017")), t.withColumns({**second, "year": F.lit("2020"), "scene": F.lit("b")}),
             t.withColumns({**third, "year": F.lit("2023"), "scene": F.lit("c")})]
    return years[0].unionByName(years[1]).unionByName(years[2])


DATED = S + """, dated AS (SELECT 2017 AS year, x, y, red, nir FROM scene UNION ALL
    SELECT 2020, x, y, (red * 3) % 256, (nir * 3) % 256 FROM scene WHERE (x + 2 * y) % 5 <> 0 UNION ALL
    SELECT 2023, x, y, (red + 7) % 256, (nir + 7) % 256 FROM scene WHERE y % 3 = 0)
"""


@query("z12_composite", DATED + """SELECT x, y, how, ROUND(red, 6) AS red, ROUND(nir, 6) AS nir FROM (
    SELECT x, y, 'latest' AS how, ARG_MAX(red, year) AS red, ARG_MAX(nir, year) AS nir FROM dated GROUP BY x, y UNION ALL
    SELECT x, y, 'earliest', ARG_MIN(red, year), ARG_MIN(nir, year) FROM dated GROUP BY x, y UNION ALL
    SELECT x, y, 'median', MEDIAN(red), MEDIAN(nir) FROM dated GROUP BY x, y UNION ALL
    SELECT x, y, 'mean', AVG(red), AVG(nir) FROM dated GROUP BY x, y UNION ALL
    SELECT x, y, 'count', COUNT(red), COUNT(nir) FROM dated GROUP BY x, y)""")
def composites(spark, sf):
    surveys = dated(spark, sf)
    out = None
    for how in composite.HOW:
        made = composite.composite(surveys, ["red", "nir"], fx.SIZE, how, cells=256)
        px = tiles.to_pixels(made.drop("n_dates"), ["red", "nir"], fx.SIZE).select(
            "x", "y", F.lit(how).alias("how"), six("red").alias("red"), six("nir").alias("nir"))
        out = px if out is None else out.unionByName(px)
    return out


@query("z12_chosen", DATED + """SELECT x, y, ARG_MAX(nir, year) AS nir, COUNT(DISTINCT year) AS surveys FROM dated
    WHERE year BETWEEN 2018 AND 2023 AND x >= 8 AND x < 24 AND y >= 16 AND y < 56 GROUP BY x, y""")
def chosen(spark, sf):
    """The latest value of surveys from 2018 on, in the tiles that an area touches."""
    some = composite.chosen(dated(spark, sf), fx.SIZE, (9.0, 17.0, 23.0, 55.0), ("2018", "2023"))
    latest = composite.composite(some, ["nir"], fx.SIZE, "latest")
    count = composite.composite(some, ["nir"], fx.SIZE, "count").select("tx", "ty", c("nir").alias("surveys"))
    px = tiles.to_pixels(latest.drop("n_dates").join(count, ["tx", "ty"]), ["nir", "surveys"], fx.SIZE)
    return px.filter("nir IS NOT NULL").select("x", "y", "nir", c("surveys").cast("long").alias("surveys"))


# ---- several kernels in one exchange --------------------------------------

@query("x02_general_tiles", GENERAL + "SELECT x, y, CAST(m AS TINYINT) AS selected FROM closed")
def general_tiles(spark, sf):
    out = workflows.general_tiles(fx.tiles(spark, sf), fx.SIZE, 1.0, 12.0, False, 0.2, "ndwi").select("scene", "tx", "ty", c("data").alias("selected"))
    return cells(out, "selected").select("x", "y", c("selected").cast("tinyint").alias("selected"))


@query("x03_landcover_tiles", LANDRUN + """SELECT x, y, CAST(ndvi AS FLOAT) AS ndvi, CAST(ndsm AS FLOAT) AS ndsm, class, cleaned, ROUND(slope, 6) AS slope,
    CAST(CASE WHEN slope < 5 THEN 0 ELSE 1 END AS TINYINT) AS slope_class FROM cells""")
def landcover_tiles(spark, sf):
    """Classes, cleaning and slope of whole tiles from one border exchange."""
    out = workflows.landcover_tiles(fx.tiles(spark, sf), fx.SIZE)
    px = cells(out, "class", "ndvi", "ndsm", "cleaned", "slope", "slope_class")
    return px.select("x", "y", c("ndvi").cast("float").alias("ndvi"), c("ndsm").cast("float").alias("ndsm"), c("class").cast("tinyint").alias("class"),
                     c("cleaned").cast("tinyint").alias("cleaned"), six("slope").alias("slope"), c("slope_class").cast("tinyint").alias("slope_class"))
