"""Queries on rasters with missing cells and bands, null groups, wide class codes and boxes of mixed sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import indices, tilemath
from terraloom.operators import algebra, focal, halo, ranking, resample, spatial, stats, tiles
from terraloom.suite import catalog as cq, fixtures as fx
from terraloom.suite.grids import NDVI, NDVI0, bilinear_sql, rows_of
from terraloom.suite.neighbours import CROSS, back, closing_sql, tiled
from terraloom.suite.registry import query, rounded, six

c = F.col

# Cells without nir, and tiles without red.
HOLE = "(x * 3 + y * 5) % 23 = 0"
NO_RED = "(x // 8 + y // 8) % 4 = 3"
GAPS_SQL = fx.SCENE_SQL.replace("scene AS (SELECT", "whole AS (SELECT") + f""",
scene AS (SELECT x, y, CASE WHEN NOT ({NO_RED}) THEN red END AS red, green, blue, CASE WHEN NOT ({HOLE}) THEN nir END AS nir, dem, dsm FROM whole)
"""
G = fx.with_sql(GAPS_SQL)


def gap_tiles(spark, sf):
    def holes(v, i):
        x, y = c("tx") * fx.SIZE + i % fx.SIZE, c("ty") * fx.SIZE + F.floor(i / fx.SIZE)
        return F.when((x * 3 + y * 5) % 23 == 0, F.lit(float("nan"))).otherwise(v)

    return fx.tiles(spark, sf).withColumns({
        "nir": F.transform("nir", holes), "red": F.when((c("tx") + c("ty")) % 4 != 3, c("red"))})


def gap_pixels(spark, sf):
    """Pixel rows that still hold NaN, as other readers make them."""
    px = tiles.to_pixels(gap_tiles(spark, sf), fx.BANDS, fx.SIZE)
    return px.withColumns({b: F.coalesce(b, F.lit(float("nan"))) for b in ("red", "nir")})


@query("r01_tilemath_gaps", G + f"SELECT x, y, ROUND({NDVI0}, 5) AS ndvi FROM scene")
def tilemath_gaps(spark, sf):
    t = gap_tiles(spark, sf).select("scene", "tx", "ty", "w", "h", tilemath.ndvi(zero="zero").alias("ndvi"))
    return tiles.to_pixels(t, ["ndvi"], fx.SIZE).select("x", "y", F.round(c("ndvi").cast("double"), 5).alias("ndvi"))


@query("mosaic_gaps", G + """SELECT x, y, COUNT(*) AS n, MAX(red) AS red, MAX(nir) AS nir FROM (SELECT x, y, red, nir FROM scene
    UNION ALL SELECT x, y, red - 1, nir FROM whole WHERE x % 2 = 0) GROUP BY x, y""")
def mosaic_gaps(spark, sf):
    other = fx.scene(spark, sf).filter("x % 2 = 0").withColumn("red", c("red") - 1)
    both = gap_pixels(spark, sf).select("scene", "x", "y", "red", "nir").unionByName(other.select("scene", "x", "y", "red", "nir"))
    return tiles.mosaic(both, ["red", "nir"]).drop("scene")


@query("z08_resize_gaps", G + bilinear_sql("(2.0::DOUBLE / 3.0::DOUBLE)", 60, "nir").replace(
    "SUM(w * value) / SUM(w)", "SUM(w * value) / SUM(w) FILTER (value IS NOT NULL)"))
def resize_gaps(spark, sf):
    px, ratio = gap_pixels(spark, sf), 2.0 / 3.0
    return resample.to_grid(px, ["nir"], ratio, ratio, 60, round(rows_of(px) / ratio)).select("x", "y", six("nir").alias("nir"))


@query("z10_overview_gaps", G + """, n AS (SELECT MAX(x) + 1 AS w, MAX(y) + 1 AS h FROM scene)
SELECT x // 3 AS x, y // 3 AS y, ROUND(AVG(red), 6) AS red, ROUND(AVG(nir), 6) AS nir FROM scene, n
WHERE x // 3 < w // 3 AND y // 3 < h // 3 GROUP BY 1, 2""")
def overview_gaps(spark, sf):
    return rounded(resample.overview(gap_pixels(spark, sf), ["red", "nir"], 3).drop("scene"), "red", "nir")


@query("r12_stretch_gaps", G + """, span AS (SELECT MIN(LEAST(red, green, blue)) AS low, MAX(GREATEST(red, green, blue)) AS high FROM scene)
SELECT x, y, ROUND((red - low) / (high - low), 6) AS red_01, ROUND((green - low) / (high - low), 6) AS green_01 FROM scene, span""")
def stretch_gaps(spark, sf):
    px = algebra.stretch(gap_pixels(spark, sf))
    return px.select("x", "y", six("red_01").alias("red_01"), six("green_01").alias("green_01"))


@query("a14_quantiles_gaps", G + """SELECT quantile_disc(nir, 0.25) AS p25, quantile_disc(nir, 0.5) AS p50,
    quantile_disc(nir, 0.75) AS p75 FROM scene""")
def quantiles_gaps(spark, sf):
    return stats.quantiles(gap_pixels(spark, sf), "nir").drop("scene")


@query("x01_tiles_gaps", G + f"""SELECT x, y, CASE WHEN red IS NOT NULL AND nir IS NOT NULL THEN
    CAST(COALESCE({NDVI} > 0.35 AND GREATEST(dsm - dem, 0.0::DOUBLE) >= 3.5, FALSE) AS TINYINT) END AS held FROM scene""")
def vegetation_gaps(spark, sf):
    """The mask of the vegetation workflow: missing where a band is, before the closing."""
    t = gap_tiles(spark, sf).select("scene", "tx", "ty", "w", "h", tilemath.vegetation(3.5).alias("held"))
    return tiles.to_pixels(t, ["held"], fx.SIZE).select("x", "y", c("held").cast("tinyint").alias("held"))


# ---- class codes ----------------------------------------------------------

WIDE = fx.SCENE_SQL + """, land AS (SELECT x, y, CASE WHEN green > 150 THEN 65 WHEN green > 120 THEN 4 ELSE 0 END AS class FROM scene)"""


def wide_sql():
    parts = [fx.with_sql(WIDE)]
    for k in (4, 65):
        parts.append(f", m{k} AS (SELECT x, y, CASE WHEN class = {k} THEN 1 ELSE 0 END AS m FROM land), ")
        parts.append(closing_sql(f"m{k}", f"c{k}", CROSS, 1))
    return "".join(parts) + """ SELECT land.x, land.y, CASE WHEN c65.m = 1 THEN 65 WHEN c4.m = 1 THEN 4 ELSE land.class END AS cleaned
    FROM land JOIN c4 ON c4.x = land.x AND c4.y = land.y JOIN c65 ON c65.x = land.x AND c65.y = land.y"""


def wide_classes(spark, sf):
    code = F.when(c("green") > 150, 65).when(c("green") > 120, 4).otherwise(0)
    return fx.scene(spark, sf).select("scene", "x", "y", code.alias("class"))


@query("z05_wide_codes", wide_sql())
def wide_codes(spark, sf):
    return focal.clean_classes(wide_classes(spark, sf), iterations=1, codes=[4, 65]).select("x", "y", c("cleaned").cast("int").alias("cleaned"))


@query("z05_wide_codes_tiles", wide_sql())
def wide_codes_tiles(spark, sf):
    long, size = tiled(wide_classes(spark, sf), "class")
    return back(halo.clean_classes(long, size, iterations=1), size, "cleaned").select("x", "y", c("cleaned").cast("int").alias("cleaned"))


@query("a09_two_classes", fx.with_sql(fx.SCENE_SQL) + f"""SELECT class, CASE class WHEN 0 THEN 'Non-vegetation' ELSE 'Vegetation' END AS label, COUNT(*) AS cells,
    ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS pct
    FROM (SELECT CASE WHEN COALESCE({NDVI} > 0.3, FALSE) THEN 1 ELSE 0 END AS class FROM scene) GROUP BY class""")
def two_classes(spark, sf):
    px = algebra.classify(algebra.ndvi(fx.scene(spark, sf))).withColumn("class", c("mask").cast("int"))
    return rounded(stats.classes(px, labels=indices.TWO_CLASS_LABELS), "pct")


# ---- groups and boxes -----------------------------------------------------

@query("v01_null_group", cq.L + """SELECT seq, NULLIF(type, 'rgb') AS type, ROW_NUMBER() OVER (PARTITION BY NULLIF(type, 'rgb') ORDER BY href, seq) AS i,
    COUNT(*) OVER (PARTITION BY NULLIF(type, 'rgb')) AS n FROM collections""")
def null_group(spark, sf):
    df = cq.parsed(spark, sf).select("seq", F.nullif(c("type"), F.lit("rgb")).alias("type"), "href")
    return ranking.row_numbers(df, "type", ["href", "seq"]).select("seq", "type", "i", "n")


@query("j06_mixed_sizes", fx.with_sql(fx.ITEMS_SQL, fx.AREAS_SQL, """
a AS (SELECT item_id, minx, miny, CASE WHEN CAST(item_id AS BIGINT) % 97 = 0 THEN minx + 40000 ELSE maxx END AS maxx,
    CASE WHEN CAST(item_id AS BIGINT) % 97 = 0 THEN miny + 90000 ELSE maxy END AS maxy FROM items WHERE minx IS NOT NULL),
b AS (SELECT b_id, b_minx, b_miny, CASE WHEN b_id % 50 = 0 THEN b_minx + 60000 ELSE b_maxx END AS b_maxx, b_maxy FROM areas)""") + """
SELECT b_id, COUNT(*) AS items FROM a JOIN b ON minx <= b_maxx AND b_minx <= maxx AND miny <= b_maxy AND b_miny <= maxy GROUP BY b_id""")
def mixed_sizes(spark, sf):
    """A few large boxes on both sides among many small ones."""
    large = c("item_id").cast("long") % 97 == 0
    a = fx.items(spark, sf).select(
        "item_id", c("minx").alias("a_minx"), c("miny").alias("a_miny"),
        F.when(large, c("minx") + 40000).otherwise(c("maxx")).alias("a_maxx"), F.when(large, c("miny") + 90000).otherwise(c("maxy")).alias("a_maxy"))
    b = fx.areas(spark, sf).withColumn("b_maxx", F.when(c("b_id") % 50 == 0, c("b_minx") + 60000).otherwise(c("b_maxx")))
    return spatial.bbox_counts(a, b, 400.0, "b_id").withColumnRenamed("n", "items")
