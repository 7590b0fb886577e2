"""Queries over raster files with several transforms and stored overviews, and over tile tables made of them."""

from __future__ import annotations

import functools
import operator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from terraloom.operators import algebra, inventory, regrid, resample, spatial, tiles
from terraloom.plans import workflows
from terraloom.sources import listing, rasters, sinks
from terraloom.suite import fixtures as fx, tiffs
from terraloom.suite.files import folder, put
from terraloom.suite.registry import query, six

c = F.col
S = fx.with_sql(fx.SCENE_SQL)
#: Tile rows of the scene in one file, and cells of a file from top to bottom.
ROWS, HIGH = 3, 3 * fx.SIZE
WIDE = 5 * fx.SIZE
#: Files lie below each other in the world, every other one at half the resolution.
FILE_SQL = f"""f AS (SELECT s.*, y // {HIGH} AS file, y % {HIGH} AS fy, CASE WHEN (y // {HIGH}) % 2 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS res,
    5000000.0::DOUBLE - (y // {HIGH}) * 30 AS top FROM scene s),
lines AS (SELECT file, MAX(fy) + 1 AS high FROM f GROUP BY file)
"""


def files_of(spark, sf, bands=fx.BANDS[:4], dtype="uint8"):
    """The scene as files of three tile rows each: strips, tiles, planes apart and sparse blocks, overviews by 2 and 4."""
    root = folder(spark)
    strips = fx.stored_tiles(spark, sf).select("tx", "ty", F.floor(c("ty") / ROWS).alias("file"), *bands)

    def encode(key, pdf):
        high = (int(pdf.ty.max()) % ROWS + 1) * fx.SIZE
        data = np.full((len(bands), high, WIDE), np.nan)  # tiles that are not there are missing cells
        for r in pdf.itertuples():
            y, x = r.ty % ROWS * fx.SIZE, r.tx * fx.SIZE
            for n, b in enumerate(bands):
                data[n, y:y + fx.SIZE, x:x + fx.SIZE] = np.reshape(np.asarray(getattr(r, b), dtype=float), (fx.SIZE, fx.SIZE))
        k, (data, nodata) = int(key[0]), tiffs.whole(data, dtype)
        res = 0.5 if k % 2 == 0 else 1.0
        # Every second and fourth cell, whole cells only.
        smaller = [data[:, f // 2::f, f // 2::f][:, :high // f, :WIDE // f] for f in (2, 4)]
        body = tiffs.encode(data, order="<>"[k % 2], deflate=k % 3 > 0, tile=16 if k % 3 else 0, rows_per_strip=5, planar=k % 4 == 1,
                            transform=(1000000.0, res, 5000000.0 - k * 30, res), epsg=2193, nodata=nodata, overviews=smaller)
        return pd.DataFrame({"key": [f"{k}.tif"], "body": [body]})

    put(strips.groupBy("file").applyInPandas(encode, "key string, body binary"), root)
    # Pages under the name of a raster: they fail, and the batch goes on.
    pages = fx.table(spark, sf, "pages").filter(c("page_id") % 50 == 3).select(
        F.concat(F.lit("p"), "page_id", F.lit("x.tif")).alias("key"), c("html").cast("binary").alias("body"))
    put(pages, root)
    # The headers are stored: several reads start from them.
    rasters.headers(listing.objects(spark, root, suffixes=(".tif",))).write.parquet(f"{root}-headers")
    return spark.read.parquet(f"{root}-headers")


BAD_SQL = "SELECT page_id FROM pages WHERE page_id % 50 = 3"


@query("s07_magic_mixed", S + ", " + FILE_SQL + f"""SELECT * FROM (SELECT CAST(file AS VARCHAR) AS name, CASE file % 2 WHEN 0 THEN '49492A0008000000' ELSE '4D4D002A00000008' END AS head, TRUE AS is_tiff
    FROM lines UNION ALL SELECT 'p' || page_id || 'x', upper(hex(substr(html, 1, 8))), FALSE FROM pages WHERE page_id % 50 = 3)""")
def magic(spark, sf):
    """Rasters of both byte orders, and pages that only have the name."""
    paths = files_of(spark, sf).agg(F.first("path")).first()[0]
    root = paths.rsplit("/", 1)[0]
    return listing.headers(spark, root, 8).select(F.regexp_extract("path", r"([^/]+)\.tif$", 1).alias("name"), "head", "is_tiff")


@query("q05_describe_levels", S + ", " + FILE_SQL + """SELECT CAST(file AS INT) AS file, file % 3 > 0 AS is_cog_b, FALSE AS is_cog_a, 2 AS levels, '2,4' AS factors FROM lines""")
def described(spark, sf):
    """Files in tiles with overviews pass the second test, those in strips do not; blocks of 16 cells fail the first."""
    df = inventory.describe(files_of(spark, sf)).filter("success")
    return df.select(number().alias("file"), "is_cog_b", "is_cog_a", F.size(c("bands")[0]["overviews"]).alias("levels"), F.concat_ws(",", c("bands")[0]["overviews"].cast("array<string>")).alias("factors"))


@query("q06_batch_mixed", S + ", " + FILE_SQL + f"SELECT success, COUNT(*) AS files FROM (SELECT TRUE AS success FROM lines UNION ALL SELECT FALSE FROM ({BAD_SQL})) GROUP BY success")
def batch_mixed(spark, sf):
    return inventory.describe(files_of(spark, sf)).groupBy("success").agg(F.count(F.lit(1)).alias("files"))


def number(path="path"):
    return F.regexp_extract(path, r"(\d+)\.tif$", 1).cast("int")


def cells(blocks, bands=fx.BANDS[:4]):
    """file, x, y and bands of blocks of either interleave."""
    long = rasters.to_tiles(blocks, bands, 16)
    px = tiles.to_pixels(long.drop("transform"), bands, 16).filter(F.coalesce(*bands).isNotNull())
    return px.withColumn("file", number("scene")).drop("scene")


def places():
    """Places of the cells of a tile."""
    return F.sequence(F.lit(0), F.lit(255))


def lacks(i, *bands):
    """Whether a tile has none of the bands at place ``i``."""
    return functools.reduce(operator.and_, [F.isnan(F.coalesce(F.get(b, i), F.lit(float("nan")))) for b in bands])


BOX = (1000003.0, 4999925.5, 1000013.2, 4999999.0)


@query("w07_files", S + ", " + FILE_SQL + f"""SELECT CAST(file AS INT) AS file, x, CAST(fy AS INT) AS y, CAST(red AS FLOAT) AS red, CAST(nir AS FLOAT) AS nir FROM f
    WHERE 1000000.0 + (x + 0.5) * res BETWEEN {BOX[0]} AND {BOX[2]} AND top - (fy + 0.5) * res BETWEEN {BOX[1]} AND {BOX[3]}""")
def window_of_files(spark, sf):
    """Only the blocks that the box touches are read, by each file's own transform."""
    return cells(rasters.blocks(files_of(spark, sf), box=BOX)).select("file", "x", "y", "red", "nir")


@query("z10_files", S + ", " + FILE_SQL + """SELECT CAST(f.file AS INT) AS file, CAST(x // 4 AS INT) AS x, CAST(fy // 4 AS INT) AS y, CAST(red AS FLOAT) AS red
    FROM f JOIN lines ON f.file = lines.file WHERE x % 4 = 2 AND fy % 4 = 2 AND fy // 4 < high // 4""")
def level_of_files(spark, sf):
    """The second stored overview; the full image is not read."""
    return cells(rasters.blocks(files_of(spark, sf), level=2)).select("file", "x", "y", "red")


@query("z10_file_grids", S + ", " + FILE_SQL + """, lv AS (SELECT * FROM (VALUES (0, 1), (1, 2), (2, 4), (5, 4)) t(level, factor))
    SELECT DISTINCT CAST(f.file AS INT) AS file, level, factor, CAST(40 // factor AS INT) AS width, CAST(high // factor AS INT) AS height, res * factor AS res, top
    FROM f JOIN lines ON f.file = lines.file, lv""")
def grids_of_files(spark, sf):
    headers = files_of(spark, sf)
    out = [rasters.level_grid(headers, n).select(
        number().alias("file"), F.lit(n).alias("level"), "factor", "width", "height", c("transform")[1].alias("res"), c("transform")[3].alias("top"))
        for n in (0, 1, 2, 5)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("s12_to_tiles", S + ", " + FILE_SQL + """SELECT CAST(file AS INT) AS file, CAST(x // 16 AS INT) AS tx, CAST(fy // 16 AS INT) AS ty, 16 AS w, 16 AS h, COUNT(*) AS cells,
    SUM(CAST(red AS BIGINT) * (1 + x % 16 + 16 * (fy % 16)))::BIGINT AS red, SUM(CAST(nir AS BIGINT) * (1 + x % 16 + 16 * (fy % 16)))::BIGINT AS nir,
    ANY_VALUE(res) AS res FROM f GROUP BY ALL""")
def blocks_to_tiles(spark, sf):
    """Strips, tiles and planes of files as square tiles; sums weighted by place compare the arrays."""
    t = rasters.to_tiles(rasters.blocks(files_of(spark, sf)), fx.BANDS[:4], 16)

    def placed(band):
        held = F.zip_with(F.col(band), F.sequence(F.lit(1), F.lit(256)), lambda v, i: F.when(F.isnan(v), 0).otherwise(v.cast("long") * i))
        return F.aggregate(held, F.lit(0).cast("long"), lambda a, v: a + v).alias(band)

    cells_ = F.size(F.filter(places(), lambda i: ~lacks(i, *fx.BANDS[:4]))).cast("long")
    return t.select(number("scene").alias("file"), "tx", "ty", "w", "h", cells_.alias("cells"),
                    placed("red"), placed("nir"), c("transform")[1].alias("res")).filter("cells > 0")


# ---- grids that differ ----------------------------------------------------

def bilinear_sql(left, top, res, band):
    """``band`` of the scene, cells of one unit from (0, 0) down, at cell centres of another grid."""
    return f"""SELECT t.x, t.y, SUM(w * s.{band}) / SUM(w) AS {band} FROM (
        SELECT x, y, FLOOR(u) + dx AS sx, FLOOR(v) + dy AS sy, (1 - ABS(u - FLOOR(u) - dx)) * (1 - ABS(v - FLOOR(v) - dy)) AS w
        FROM (SELECT x, y, {left} + (x + 0.5::DOUBLE) * {res} - 0.5::DOUBLE AS u, {top} + (y + 0.5::DOUBLE) * {res} - 0.5::DOUBLE AS v FROM grid),
             (VALUES (0), (1)) p(dx), (VALUES (0), (1)) q(dy)) t JOIN scene s ON s.x = t.sx AND s.y = t.sy WHERE w > 1e-9 GROUP BY t.x, t.y"""


@query("j03_tiles", S + f""", n AS (SELECT MAX(y) + 1 AS high FROM scene), base AS (SELECT x, y, red FROM scene),
    grid AS (SELECT x, y FROM scene), dsm AS ({bilinear_sql("5.25::DOUBLE", "2.5::DOUBLE", "0.5::DOUBLE", "dsm")}),
    dem AS (SELECT g.x, g.y, s.dem FROM grid g JOIN scene s ON s.x = FLOOR(5.25::DOUBLE + (g.x + 0.5::DOUBLE) * 0.5) AND s.y = FLOOR(2.5::DOUBLE + (g.y + 0.5::DOUBLE) * 0.5))
    SELECT base.x, base.y, red, ROUND(dsm, 6) AS dsm, ROUND(dem, 6) AS dem FROM base LEFT JOIN dsm ON dsm.x = base.x AND dsm.y = base.y
    LEFT JOIN dem ON dem.x = base.x AND dem.y = base.y""")
def overlay_of_grids(spark, sf):
    """Imagery at half a unit with its own origin over elevation at one unit: arrays meet on tile keys."""
    t = fx.tiles(spark, sf)
    grid = lambda left, top, res: F.array(*[F.lit(float(v)) for v in (left, res, 0, top, 0, -res)])
    base = t.select("scene", "tx", "ty", "w", "h", grid(1005.25, 2000 - 2.5, 0.5).alias("transform"), "red")
    under = t.withColumns({"scene": F.lit("elevation"), "transform": grid(1000, 2000, 1)})
    both = regrid.overlay(base, under.drop("red", "green", "blue", "nir", "dem"), ["dsm"], fx.SIZE, cell=16.0)
    both = regrid.overlay(both, under.drop("red", "green", "blue", "nir", "dsm"), ["dem"], fx.SIZE, "nearest", cell=16.0)
    px = tiles.to_pixels(both.drop("transform"), ["red", "dsm", "dem"], fx.SIZE)
    return px.select("x", "y", "red", six("dsm").alias("dsm"), six("dem").alias("dem"))


def resized_tiles(spark, sf, bands, ratio, columns, method, rows):
    t = regrid.resize(fx.tiles(spark, sf), bands, fx.SIZE, ratio, ratio, columns, rows, method)
    return tiles.to_pixels(t, bands, fx.SIZE).filter(c(bands[0]).isNotNull()).select("x", "y", *[six(b).alias(b) for b in bands])


def rows_of(spark, sf):
    """Cells of the scene from top to bottom."""
    return (fx.tiles(spark, sf).agg(F.max("ty")).first()[0] + 1) * fx.SIZE


@query("z08_resize_tiles", S + f""", n AS (SELECT CAST(ROUND((MAX(y) + 1) * 1.5) AS INT) AS rows FROM scene),
    grid AS (SELECT CAST(a.x AS INT) AS x, CAST(b.y AS INT) AS y FROM range(60) a(x), (SELECT UNNEST(range(rows)) AS y FROM n) b)
    SELECT x, y, ROUND(dsm, 6) AS dsm FROM ({bilinear_sql("0.0::DOUBLE", "0.0::DOUBLE", "(2.0::DOUBLE / 3.0::DOUBLE)", "dsm")})""")
def resize_tiles(spark, sf):
    return resized_tiles(spark, sf, ["dsm"], 2.0 / 3.0, 60, "bilinear", round(rows_of(spark, sf) * 1.5))


@query("z09_average_tiles", S + """SELECT CAST(FLOOR((x + 0.5) / 2.5) AS INT) AS x, CAST(FLOOR((y + 0.5) / 2.5) AS INT) AS y,
    ROUND(AVG(dsm), 6) AS dsm, ROUND(AVG(red), 6) AS red FROM scene GROUP BY 1, 2""")
def average_tiles(spark, sf):
    return resized_tiles(spark, sf, ["dsm", "red"], 2.5, 40, "average", rows_of(spark, sf))


@query("z09_nearest_tiles", S + """, n AS (SELECT MAX(y) + 1 AS rows FROM scene),
    target AS (SELECT CAST(a.x AS INT) AS x, CAST(b.y AS INT) AS y FROM range(100) a(x), (SELECT UNNEST(range(CAST(ROUND(rows / 0.4) AS INT))) AS y FROM n) b)
    SELECT t.x, t.y, s.red FROM target t JOIN scene s ON s.x = FLOOR((t.x + 0.5) * 0.4::DOUBLE) AND s.y = FLOOR((t.y + 0.5) * 0.4::DOUBLE)""")
def nearest_tiles(spark, sf):
    return resized_tiles(spark, sf, ["red"], 0.4, 100, "nearest", round(rows_of(spark, sf) / 0.4))


@query("z10_pyramid", S + """, n AS (SELECT MAX(x) + 1 AS w, MAX(y) + 1 AS h FROM scene), lv AS (SELECT * FROM (VALUES (1, 2), (2, 3), (3, 4), (4, 8)) t(level, factor))
    SELECT level, factor, CAST(x // factor AS INT) AS x, CAST(y // factor AS INT) AS y, ROUND(AVG(red), 6) AS red, ROUND(AVG(nir), 6) AS nir FROM scene, n, lv
    WHERE x // factor < w // factor AND y // factor < h // factor GROUP BY ALL""")
def pyramid(spark, sf):
    """Four levels from one scan."""
    levels = regrid.pyramid(fx.tiles(spark, sf), ["red", "nir"], fx.SIZE, [2, 3, 4, 8], WIDE, rows_of(spark, sf))
    px = tiles.to_pixels(levels, ["red", "nir"], fx.SIZE).filter("red IS NOT NULL")
    return px.select("level", "factor", "x", "y", six("red").alias("red"), six("nir").alias("nir"))


@query("z11_pyramid_levels", S + """, n AS (SELECT MAX(x) + 1 AS w, MAX(y) + 1 AS h FROM scene), lv AS (SELECT * FROM (VALUES (1, 2), (2, 3), (3, 4), (4, 8)) t(level, factor))
    SELECT level, factor, CAST((w // factor) * (h // factor) AS BIGINT) AS cells, ROUND((w // factor) * (h // factor) * 100.0::DOUBLE / (w * h), 6) AS kept_pct FROM n, lv""")
def pyramid_levels(spark, sf):
    """Cells that each level really has, counted in its arrays."""
    high = rows_of(spark, sf)
    levels = regrid.pyramid(fx.tiles(spark, sf), ["red"], fx.SIZE, [2, 3, 4, 8], WIDE, high)
    held = F.size(F.filter("red", lambda v: ~F.isnan(v)))
    return levels.groupBy("level", "factor").agg(F.sum(held).alias("cells")).withColumn("kept_pct", six(c("cells") * 100.0 / (WIDE * high)))


# ---- files to result ------------------------------------------------------

@query("x01_from_files", S + f""", e AS (SELECT x, y, (nir - red) / NULLIF(nir + red, 0) AS v, GREATEST(FLOOR(dsm) - FLOOR(dem), 0) AS h, nir + red AS t FROM scene),
    m AS (SELECT x, y, CASE WHEN v > 0.35 AND h >= 3.5 THEN 1 ELSE 0 END AS mask, y // {HIGH} AS file FROM e),
    grown AS (SELECT a.file, a.x, a.y, MAX(b.mask) AS mask FROM m a JOIN m b ON a.file = b.file AND ABS(a.x - b.x) <= 1 AND ABS(a.y - b.y) <= 1 GROUP BY ALL),
    around AS (SELECT a.file, a.x, a.y, MIN(b.mask) AS mask, COUNT(*) AS n FROM grown a JOIN grown b ON a.file = b.file AND ABS(a.x - b.x) <= 1 AND ABS(a.y - b.y) <= 1 GROUP BY ALL)
    SELECT CAST(file AS INT) AS file, x, CAST(y % {HIGH} AS INT) AS y, CASE WHEN n = 9 THEN mask ELSE 0 END AS vegetation FROM around""")
def vegetation_of_files(spark, sf):
    """Imagery and elevation files of the same areas: blocks, square tiles, overlay, vegetation mask."""
    imagery = rasters.to_tiles(rasters.blocks(files_of(spark, sf)), fx.BANDS[:4], 16)
    # A cell that has other bands, but not both of the index, is no vegetation: as 0 and 0 it has no index.
    bare = lambda i: (lacks(i, "red") | lacks(i, "nir")) & ~lacks(i, *fx.BANDS[:4])
    # Worked out first: inside a lambda Spark takes the name of a band for the new band of the same step.
    imagery = imagery.withColumn("bare", F.transform(places(), bare))
    imagery = imagery.withColumns({b: F.transform(places(), lambda i: F.when(F.get("bare", i), F.lit(0.0).cast("float")).otherwise(F.get(b, i))) for b in ("red", "nir")}).drop("bare")
    heights = rasters.to_tiles(rasters.blocks(files_of(spark, sf, ["dsm", "dem"], "uint16")), ["dsm", "dem"], 16)
    out = workflows.vegetation_of_grids(imagery, heights, 16, 3.5)
    px = tiles.to_pixels(out.select("scene", "tx", "ty", F.lit(16).alias("w"), c("data").alias("v")), ["v"], 16).filter("v IS NOT NULL")
    return px.select(number("scene").alias("file"), "x", "y", c("v").cast("int").alias("vegetation"))


# ---- a transform per scene ------------------------------------------------

def tables_of_files(spark, sf):
    return rasters.to_tiles(rasters.blocks(files_of(spark, sf)), fx.BANDS[:4], 16)


@query("w07_scenes", S + ", " + FILE_SQL + f"""SELECT CAST(file AS INT) AS file, x, CAST(fy AS INT) AS y, CAST(red AS FLOAT) AS red FROM f
    WHERE 1000000.0 + (x + 0.5) * res BETWEEN {BOX[0]} AND {BOX[2]} AND top - (fy + 0.5) * res BETWEEN {BOX[1]} AND {BOX[3]}""")
def window_of_scenes(spark, sf):
    """A tile table of scenes on different grids: each has its own transform."""
    px = spatial.clip_tiles_world(tables_of_files(spark, sf), fx.BANDS[:4], 16, BOX)
    return px.filter(F.coalesce(*fx.BANDS[:4]).isNotNull()).select(number("scene").alias("file"), "x", "y", "red")


@query("z13_scenes", S + ", " + FILE_SQL + "SELECT CAST(file AS INT) AS file, x, CAST(fy AS INT) AS y, 1000000.0::DOUBLE + (x + 0.5) * res AS world_x, top - (fy + 0.5) * res AS world_y FROM f")
def world_of_scenes(spark, sf):
    px = tiles.to_pixels(tables_of_files(spark, sf).select("scene", "tx", "ty", "w", "transform", *fx.BANDS[:4]), fx.BANDS[:4], 16)
    return resample.world_of_scene(px.filter(F.coalesce(*fx.BANDS[:4]).isNotNull())).select(number("scene").alias("file"), "x", "y", "world_x", "world_y")


@query("k04_scenes", S + ", " + FILE_SQL + """SELECT CAST(file AS INT) AS file, band, 'EPSG:2193' AS crs, res, top, SUM(v)::BIGINT AS total
    FROM (SELECT file, res, top, 'red' AS band, red AS v FROM f UNION ALL SELECT file, res, top, 'nir', nir FROM f) GROUP BY ALL""")
def saved_scenes(spark, sf):
    """Tiles are saved with the crs and the transform of their scene."""
    root = folder(spark)
    long = tiles.by_band(tables_of_files(spark, sf).select("scene", "tx", "ty", "w", "h", "transform", "red", "nir"), ["red", "nir"])
    sinks.tiles(long, root, F.lit("EPSG:2193"))
    back = spark.read.parquet(root)
    total = F.aggregate("data", F.lit(0).cast("long"), lambda a, v: a + F.when(F.isnan(v), 0).otherwise(v.cast("long")))
    return back.groupBy(number("scene").alias("file"), "band", "crs", c("transform")[1].alias("res"), c("transform")[3].alias("top")).agg(F.sum(total).alias("total"))


@query("a11_changed_tiles", S + """SELECT COUNT(*) FILTER (a <> b)::BIGINT AS changed, COUNT(*)::BIGINT AS cells, ROUND(COUNT(*) FILTER (a <> b) * 100.0::DOUBLE / COUNT(*), 6) AS changed_pct
    FROM (SELECT FLOOR(red / 64) AS a, FLOOR(nir / 64) AS b FROM scene)""")
def changed_tiles(spark, sf):
    t = fx.tiles(spark, sf)
    one, two = (t.select("scene", "tx", "ty", F.transform(b, lambda v: F.floor(v / 64)).alias("class")) for b in ("red", "nir"))
    return algebra.changed_tiles(one, two).select("changed", "cells", six("changed_pct").alias("changed_pct"))


@query("r11_hsv_unit", S.replace("scene AS (", "whole AS (").rstrip() + """,
    b AS (SELECT x, y, FLOOR(red / 256 * 255) AS r, FLOOR(green / 256 * 255) AS g, FLOOR(blue / 256 * 255) AS b FROM whole),
    t AS (SELECT *, GREATEST(r, g, b) AS top, GREATEST(r, g, b) - LEAST(r, g, b) AS span FROM b),
    d AS (SELECT *, CASE WHEN span = 0 THEN 0 WHEN top = r THEN 60 * (g - b) / span WHEN top = g THEN 120 + 60 * (b - r) / span ELSE 240 + 60 * (r - g) / span END AS deg FROM t)
    SELECT x, y, CAST(ROUND(CASE WHEN deg < 0 THEN deg + 360 ELSE deg END / 2) AS INT) % 180 AS hue,
    CAST(CASE WHEN top = 0 THEN 0 ELSE ROUND(255 * span / top) END AS INT) AS saturation, CAST(top AS INT) AS value FROM d""")
def hsv_unit(spark, sf):
    """The pixel form on a scene with values up to 1."""
    px = fx.scene(spark, sf).withColumns({b: c(b) / 256 for b in ("red", "green", "blue")})
    return algebra.hsv(px).select("x", "y", "hue", "saturation", "value")
