"""Map algebra, windows, statistics and resampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import indices
from terraloom.operators import algebra, composite, resample, spatial, stats, tiles
from terraloom.suite import fixtures as fx
from terraloom.suite.registry import query, rounded, six

c = F.col
S = fx.with_sql(fx.SCENE_SQL)
NDVI = "CASE WHEN nir + red <> 0 THEN (nir - red) / (nir + red) END"
NDVI0 = "CASE WHEN nir + red = 0 THEN 0.0::DOUBLE ELSE (nir - red) / (nir + red) END"
NDWI = "CASE WHEN green + nir <> 0 THEN (green - nir) / (green + nir) END"
BRIGHT = "SQRT(red * red + green * green + blue * blue)"
NDSM = "GREATEST(dsm - dem, 0.0::DOUBLE)"
LEFT, TOP, RES = 1000000.0, 5000000.0, 0.5
WINDOW = (1000003.0, 4999950.0, 1000015.5, 4999990.25)


# ---- map algebra ----------------------------------------------------------

@query("r01_ndvi", S + f"SELECT x, y, ROUND({NDVI}, 6) AS ndvi FROM scene")
def ndvi(spark, sf):
    return algebra.ndvi(fx.scene(spark, sf)).select("x", "y", six("ndvi").alias("ndvi"))


@query("r01_ndvi_tiles", S + f"SELECT x, y, ROUND({NDVI}, 6) AS ndvi FROM scene")
def ndvi_tiles(spark, sf):
    """The same on whole arrays, exploded only to be compared."""
    t = fx.tiles(spark, sf).withColumn("ndvi", indices.over_arrays(indices.ndvi, c("nir"), c("red")))
    px = tiles.to_pixels(t.select("scene", "tx", "ty", "w", "h", "ndvi"), ["ndvi"], fx.SIZE)
    return px.select("x", "y", six("ndvi").alias("ndvi"))


@query("r01_ndvi_zero", S + f"SELECT x, y, ROUND({NDVI0}, 6) AS ndvi FROM scene")
def ndvi_zero(spark, sf):
    return algebra.ndvi(fx.scene(spark, sf), zero="zero").select("x", "y", six("ndvi").alias("ndvi"))


@query("r02_ndwi", S + f"SELECT x, y, ROUND({NDWI}, 6) AS ndwi FROM scene")
def ndwi(spark, sf):
    return algebra.ndwi(fx.scene(spark, sf)).select("x", "y", six("ndwi").alias("ndwi"))


@query("r03_brightness", S + f"SELECT x, y, ROUND({BRIGHT}, 6) AS brightness FROM scene")
def brightness(spark, sf):
    return algebra.brightness(fx.scene(spark, sf)).select("x", "y", six("brightness").alias("brightness"))


def urban(spark, sf):
    return algebra.brightness(algebra.ndvi(fx.scene(spark, sf)))


@query("r04_urban_index", S + f"SELECT x, y, ROUND({BRIGHT} * (1 - {NDVI}), 6) AS urban_index FROM scene")
def urban_index(spark, sf):
    return algebra.urban_index(urban(spark, sf)).select("x", "y", six("urban_index").alias("urban_index"))


@query("r05_urban_mask", S + f"""SELECT x, y, CAST(CASE WHEN {NDVI} < 0.2 AND {BRIGHT} > 1.0 THEN 1 ELSE 0 END AS TINYINT) AS urban
FROM scene""")
def urban_mask(spark, sf):
    return algebra.urban_mask(urban(spark, sf)).select("x", "y", "urban")


@query("r06_ndsm", S + f"SELECT x, y, ROUND({NDSM}, 6) AS ndsm FROM scene")
def ndsm(spark, sf):
    return algebra.ndsm(fx.scene(spark, sf)).select("x", "y", six("ndsm").alias("ndsm"))


@query("r07_vegetation_mask", S + f"SELECT x, y, COALESCE({NDVI} > 0.35, FALSE) AS vegetation FROM scene")
def vegetation_mask(spark, sf):
    px = algebra.ndvi(fx.scene(spark, sf))
    return px.select("x", "y", indices.vegetation_mask(c("ndvi")).alias("vegetation"))


@query("r08_threshold_mask", S + f"""SELECT x, y, COALESCE({NDVI} > 0.1, FALSE) AS above, COALESCE({NDVI} < 0.1, FALSE) AS below
FROM scene""")
def threshold_mask(spark, sf):
    px = algebra.ndvi(fx.scene(spark, sf))
    px = algebra.classify(px, "ndvi", True, 0.1, "above")
    return algebra.classify(px, "ndvi", False, 0.1, "below").select("x", "y", "above", "below")


@query("w05_index_filter", S + f"SELECT x, y, ROUND({NDWI}, 6) AS ndwi FROM scene WHERE {NDWI} < 0.05")
def index_filter(spark, sf):
    px = algebra.ndwi(fx.scene(spark, sf))
    return px.filter(indices.threshold_mask(c("ndwi"), 0.05, False)).select("x", "y", six("ndwi").alias("ndwi"))


@query("w06_height_range", S + f"SELECT x, y, ROUND({NDSM}, 6) AS ndsm FROM scene WHERE {NDSM} >= 2 AND {NDSM} <= 6.5")
def height_range(spark, sf):
    px = algebra.ndsm(fx.scene(spark, sf))
    return px.filter(indices.height_mask(c("ndsm"), 2.0, 6.5)).select("x", "y", six("ndsm").alias("ndsm"))


def land_sql(limit=""):
    tree = f"v > 0.3 AND h > 3.5 {limit}"
    return f"""CAST(CASE WHEN {tree} THEN 3 WHEN v > 0.3 AND h <= 3.5 THEN 2
        WHEN v <= 0.3 AND h > 3.5 THEN 1 ELSE 0 END AS TINYINT)"""


LAND = fx.SCENE_SQL + f""",
land AS (SELECT x, y, v, h, {land_sql()} AS class, {land_sql('AND h <= 8')} AS class_capped,
    CAST(CASE WHEN v > 0.3 THEN 1 ELSE 0 END AS TINYINT) AS class_flat
    FROM (SELECT x, y, {NDVI0} AS v, {NDSM} AS h FROM scene))
"""


@query("r09_landcover", fx.with_sql(LAND) + "SELECT x, y, class, class_capped, class_flat FROM land")
def landcover(spark, sf):
    px = algebra.ndsm(algebra.ndvi(fx.scene(spark, sf), zero="zero"))
    px = algebra.landcover(px)
    px = algebra.landcover(px, max_height=8.0, out="class_capped")
    return algebra.landcover(px, use_height=False, out="class_flat").select(
        "x", "y", "class", "class_capped", "class_flat")


HSV = S + """, b AS (SELECT x, y, red AS r, green AS g, blue AS b, GREATEST(red, green, blue) AS top,
    LEAST(red, green, blue) AS low FROM scene),
d AS (SELECT *, CASE WHEN top = low THEN 0.0::DOUBLE WHEN top = r THEN 60 * (g - b) / (top - low)
    WHEN top = g THEN 120 + 60 * (b - r) / (top - low) ELSE 240 + 60 * (r - g) / (top - low) END AS deg FROM b)
SELECT x, y, CAST(ROUND((CASE WHEN deg < 0 THEN deg + 360 ELSE deg END) / 2) AS INT) % 180 AS hue,
    CAST(CASE WHEN top = 0 THEN 0 ELSE ROUND(255 * (top - low) / top) END AS INT) AS saturation,
    CAST(top AS INT) AS value FROM d"""


@query("r11_hsv", HSV)
def hsv(spark, sf):
    return algebra.hsv(fx.scene(spark, sf)).select("x", "y", "hue", "saturation", "value")


@query("r12_stretch", S + """, m AS (SELECT MIN(LEAST(red, green, blue)) AS lo, MAX(GREATEST(red, green, blue)) AS hi FROM scene)
SELECT x, y, ROUND((red - lo) / (hi - lo), 6) AS red_01, ROUND((green - lo) / (hi - lo), 6) AS green_01,
    ROUND((blue - lo) / (hi - lo), 6) AS blue_01 FROM scene, m""")
def stretch(spark, sf):
    return rounded(algebra.stretch(fx.scene(spark, sf)).select("x", "y", "red_01", "green_01", "blue_01"),
                   "red_01", "green_01", "blue_01")


@query("r13_cast_float", S + "SELECT x, y, CAST(red AS FLOAT) AS red, CAST(dem AS FLOAT) AS dem FROM scene")
def cast_float(spark, sf):
    return algebra.cast_bands(fx.scene(spark, sf), ["red", "dem"]).select("x", "y", "red", "dem")


@query("r14_clip_index", S + """SELECT x, y, ROUND(GREATEST(LEAST((green - 100) / 50, 1.0::DOUBLE), -1.0::DOUBLE), 6) AS clipped FROM scene""")
def clip_index(spark, sf):
    return fx.scene(spark, sf).select("x", "y", six(indices.clip((c("green") - 100) / 50)).alias("clipped"))


@query("p14_band_select", S + "SELECT x, y, red AS band_1, nir AS band_4 FROM scene")
def band_select(spark, sf):
    return fx.scene(spark, sf).select("x", "y", c("red").alias("band_1"), c("nir").alias("band_4"))


# ---- windows --------------------------------------------------------------

@query("w07_window", S + f"""SELECT x, y, red FROM scene
WHERE {LEFT} + (x + 0.5) * {RES} BETWEEN {WINDOW[0]} AND {WINDOW[2]}
  AND {TOP} - (y + 0.5) * {RES} BETWEEN {WINDOW[1]} AND {WINDOW[3]}""")
def window(spark, sf):
    return spatial.clip(fx.scene(spark, sf), WINDOW, LEFT, TOP, RES).select("x", "y", "red")


@query("w07_window_tiles", S + f"""SELECT x, y, red FROM scene
WHERE {LEFT} + (x + 0.5) * {RES} BETWEEN {WINDOW[0]} AND {WINDOW[2]}
  AND {TOP} - (y + 0.5) * {RES} BETWEEN {WINDOW[1]} AND {WINDOW[3]}""")
def window_tiles(spark, sf):
    return spatial.clip_tiles(fx.tiles(spark, sf), ["red"], fx.SIZE, WINDOW, LEFT, TOP, RES).select("x", "y", "red")


@query("w08_crop_to_imagery", S + f""", b AS (SELECT MIN(x) AS x0, MAX(x) AS x1, MIN(y) AS y0, MAX(y) AS y1
    FROM scene WHERE {NDVI} > 0.9)
SELECT x, y, dsm FROM scene, b WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""")
def crop(spark, sf):
    px = fx.scene(spark, sf)
    imagery = algebra.ndvi(px).filter(c("ndvi") > 0.9)
    return spatial.clip_to(px, imagery).select("x", "y", "dsm")


CENTRE = S + """, m AS (SELECT (MIN(x) + MAX(x) + 1) / 2 AS cx, (MIN(y) + MAX(y) + 1) / 2 AS cy FROM scene),
inside AS (SELECT x, y, nir, ABS(x + 0.5 - cx) <= 12 AND ABS(y + 0.5 - cy) <= 12 AS kept FROM scene, m)
"""


@query("w09_centre_box", CENTRE + "SELECT x, y, nir FROM inside WHERE kept")
def centre_box(spark, sf):
    return spatial.centre_box(fx.scene(spark, sf), 12).select("x", "y", "nir")


@query("w09_centre_share", CENTRE + """SELECT COUNT(*) FILTER (kept) AS inside, COUNT(*) AS cells,
    ROUND(COUNT(*) FILTER (kept) * 100.0::DOUBLE / COUNT(*), 6) AS kept_pct FROM inside""")
def centre_share(spark, sf):
    return rounded(spatial.centre_share(fx.scene(spark, sf), 12).drop("scene"), "kept_pct")


@query("j03_align_rasters", S + f"SELECT x, y, red, nir, ROUND(dsm - dem, 6) AS height FROM scene")
def align(spark, sf):
    px = fx.scene(spark, sf)
    imagery, dsm, dem = px.select("scene", "x", "y", "red", "nir"), px.select("scene", "x", "y", "dsm"), px.select(
        "scene", "x", "y", "dem")
    return spatial.aligned(imagery, dsm, dem).select("x", "y", "red", "nir", six(c("dsm") - c("dem")).alias("height"))


MOSAIC = fx.with_sql(fx.STRIPS_SQL)


@query("mosaic_overlaps", MOSAIC + """SELECT scene, x, y, COUNT(*) AS n, MAX(red) AS red, MAX(green) AS green, MAX(blue) AS blue, MAX(nir) AS nir
FROM strips GROUP BY scene, x, y""")
def mosaic(spark, sf):
    return tiles.mosaic(fx.strips(spark, sf), ["red", "green", "blue", "nir"])


# ---- statistics -----------------------------------------------------------

def band_stats_sql(source, bands, scene=""):
    head = "scene, " if scene else ""
    rows = " UNION ALL ".join(f"SELECT {head}'{b}' AS band, {b} AS v FROM {source}" for b in bands)
    return f"""SELECT {head}band, COUNT(v) AS cells, MIN(v) AS min, MAX(v) AS max, ROUND(AVG(v), 6) AS mean,
    ROUND(STDDEV_POP(v), 6) AS std FROM ({rows}) GROUP BY {head}band"""


FOUR = ["red", "green", "blue", "nir"]


@query("a07_band_stats", S + band_stats_sql("scene", FOUR))
def band_stats(spark, sf):
    return rounded(stats.bands(fx.scene(spark, sf), FOUR).drop("scene"), "mean", "std")


@query("a07_band_stats_tiles", S + band_stats_sql("scene", FOUR))
def band_stats_tiles(spark, sf):
    return rounded(stats.bands_of_tiles(fx.tiles(spark, sf), FOUR).drop("scene"), "mean", "std")


@query("a07_raster_stats", S + f"""SELECT COUNT(v) AS cells, MIN(v) AS min, MAX(v) AS max, ROUND(AVG(v), 6) AS mean,
    ROUND(STDDEV_POP(v), 6) AS std FROM ({' UNION ALL '.join(f'SELECT {b} AS v FROM scene' for b in FOUR)})""")
def raster_stats(spark, sf):
    return rounded(stats.whole(fx.scene(spark, sf), FOUR), "mean", "std")


@query("a08_threshold_shares", S + f"""SELECT COUNT(*) AS cells,
    COUNT(*) FILTER (v > 0.3) AS vegetation_count, ROUND(COUNT(*) FILTER (v > 0.3) * 100.0::DOUBLE / COUNT(*), 6) AS vegetation_pct,
    COUNT(*) FILTER (v > 0.5) AS healthy_count, ROUND(COUNT(*) FILTER (v > 0.5) * 100.0::DOUBLE / COUNT(*), 6) AS healthy_pct,
    COUNT(*) FILTER (h > 3) AS above_3m_count, ROUND(COUNT(*) FILTER (h > 3) * 100.0::DOUBLE / COUNT(*), 6) AS above_3m_pct,
    COUNT(*) FILTER (h > 10) AS above_10m_count, ROUND(COUNT(*) FILTER (h > 10) * 100.0::DOUBLE / COUNT(*), 6) AS above_10m_pct
    FROM (SELECT {NDVI} AS v, {NDSM} AS h FROM scene)""")
def threshold_shares(spark, sf):
    px = algebra.ndsm(algebra.ndvi(fx.scene(spark, sf)))
    df = stats.thresholds(px, {
        "vegetation": c("ndvi") > 0.3, "healthy": c("ndvi") > 0.5,
        "above_3m": c("ndsm") > 3, "above_10m": c("ndsm") > 10,
    })
    return rounded(df, "vegetation_pct", "healthy_pct", "above_3m_pct", "above_10m_pct")


@query("a09_class_histogram", fx.with_sql(LAND) + """SELECT class, CASE class WHEN 0 THEN 'Ground/Bare'
    WHEN 1 THEN 'Non-vegetation objects' WHEN 2 THEN 'Low vegetation' ELSE 'High vegetation (trees)' END AS label,
    COUNT(*) AS cells, ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS pct FROM land GROUP BY class""")
def class_histogram(spark, sf):
    px = algebra.landcover(algebra.ndsm(algebra.ndvi(fx.scene(spark, sf), zero="zero")))
    return rounded(stats.classes(px), "pct")


@query("a11_changed_classes", fx.with_sql(fx.SURVEYS_SQL) + f"""SELECT COUNT(*) FILTER (a.k <> b.k) AS changed, COUNT(*) AS cells,
    ROUND(COUNT(*) FILTER (a.k <> b.k) * 100.0::DOUBLE / COUNT(*), 6) AS changed_pct
FROM (SELECT x, y, COALESCE({NDVI} > 0.3, FALSE) AS k FROM surveys WHERE year = '2017') a
JOIN (SELECT x, y, COALESCE({NDVI} > 0.3, FALSE) AS k FROM surveys WHERE year = '2020') b USING (x, y)""")
def changed_classes(spark, sf):
    px = algebra.classify(algebra.ndvi(fx.surveys(spark, sf)), out="class")
    return rounded(
        algebra.changed(px.filter(c("year") == "2017"), px.filter(c("year") == "2020")), "changed_pct")


@query("a12_negative_heights", S + """SELECT COUNT(*) AS cells, COUNT(*) FILTER (dsm < dem) AS corrected_count,
    ROUND(COUNT(*) FILTER (dsm < dem) * 100.0::DOUBLE / COUNT(*), 6) AS corrected_pct FROM scene""")
def negative_heights(spark, sf):
    return rounded(stats.thresholds(fx.scene(spark, sf), {"corrected": c("dsm") < c("dem")}), "corrected_pct")


@query("a13_stats_by_file", fx.with_sql(fx.STRIPS_SQL + """,
mosaic AS (SELECT scene, x, y, MAX(red) AS red, MAX(green) AS green, MAX(blue) AS blue, MAX(nir) AS nir
    FROM strips GROUP BY scene, x, y)""") + band_stats_sql("mosaic", FOUR, "scene"))
def stats_by_file(spark, sf):
    return rounded(stats.bands(tiles.mosaic(fx.strips(spark, sf), FOUR), FOUR), "mean", "std")


@query("a14_approx_stats", S + band_stats_sql("(SELECT nir FROM scene WHERE x % 4 = 2 AND y % 4 = 2)", ["nir"]))
def approx_stats(spark, sf):
    """The operator itself reads an overview's share of the cells."""
    return rounded(stats.approx(fx.scene(spark, sf), "nir").drop("scene"), "mean", "std")


@query("a14_approx_quantiles", S + """SELECT quantile_disc(nir, 0.25) AS p25, quantile_disc(nir, 0.5) AS p50,
    quantile_disc(nir, 0.75) AS p75 FROM scene""")
def approx_quantiles(spark, sf):
    return stats.quantiles(fx.scene(spark, sf), "nir").drop("scene")


@query("a15_histogram", S + """SELECT CAST(FLOOR(green + 0.5) AS INT) AS bin, COUNT(*) AS cells FROM scene
WHERE green >= -0.5 AND green < 255.5 GROUP BY 1""")
def histogram(spark, sf):
    return stats.histogram(fx.scene(spark, sf), "green")


def mixed_sql(band):
    place = "((x::BIGINT * 31 + y) % 2147483647 * 48271 % 2147483647)"
    both = f"(({place} + CAST(FLOOR({band} * 1024 + 0.5) AS BIGINT) % 2147483647) * 69621 % 2147483647)"
    return f"CAST(SUM(CAST({both} * {both} % 2147483647 AS HUGEINT)) % 2305843009213693951 AS BIGINT)"


@query("a16_fingerprint", S + " UNION ALL ".join(
    f"SELECT 'a' AS scene, '{b}' AS band, {mixed_sql(b)} AS checksum, COUNT(*) AS cells FROM scene" for b in FOUR))
def fingerprint(spark, sf):
    return stats.fingerprint(fx.scene(spark, sf), FOUR)


# ---- resampling -----------------------------------------------------------

def rows_of(px):
    return px.agg(F.max("y")).first()[0] + 1


def bilinear_sql(ratio, columns, band):
    return f""", n AS (SELECT CAST(ROUND((MAX(y) + 1) / ({ratio})) AS INT) AS rows FROM scene),
target AS (SELECT CAST(a.x AS INT) AS x, CAST(b.y AS INT) AS y, (a.x + 0.5) * {ratio} - 0.5 AS u, (b.y + 0.5) * {ratio} - 0.5 AS v
    FROM range({columns}) a(x), (SELECT UNNEST(range(rows)) AS y FROM n) b),
near AS (SELECT x, y, u, v, FLOOR(u) + dx AS sx, FLOOR(v) + dy AS sy FROM target, (VALUES (0), (1)) p(dx), (VALUES (0), (1)) q(dy)),
weighed AS (SELECT near.x, near.y, (1 - ABS(u - sx)) * (1 - ABS(v - sy)) AS w, s.{band} AS value
    FROM near JOIN scene s ON s.x = near.sx AND s.y = near.sy)
SELECT x, y, ROUND(SUM(w * value) / SUM(w), 6) AS {band} FROM weighed WHERE w > 1e-9 GROUP BY x, y"""


@query("z08_resize", S + bilinear_sql("(2.0::DOUBLE / 3.0::DOUBLE)", 60, "dsm"))
def resize(spark, sf):
    px = fx.scene(spark, sf)
    ratio = 2.0 / 3.0
    df = resample.to_grid(px, ["dsm"], ratio, ratio, 60, round(rows_of(px) / ratio))
    return df.select("x", "y", six("dsm").alias("dsm"))


@query("z09_to_resolution", S + bilinear_sql("0.4::DOUBLE", 100, "dem"))
def to_resolution(spark, sf):
    px = fx.scene(spark, sf)
    df = resample.to_resolution(px, ["dem"], 1.0, 0.4, 40, rows_of(px))
    return df.select("x", "y", six("dem").alias("dem"))


@query("z09_average_shrink", S + """SELECT CAST(FLOOR((x + 0.5) / 2.5) AS INT) AS x, CAST(FLOOR((y + 0.5) / 2.5) AS INT) AS y,
    ROUND(AVG(dsm), 6) AS dsm, ROUND(AVG(red), 6) AS red FROM scene GROUP BY 1, 2""")
def average_shrink(spark, sf):
    px = fx.scene(spark, sf)
    df = resample.to_resolution(px, ["dsm", "red"], 1.0, 2.5, 40, rows_of(px), "average")
    return rounded(df.drop("scene"), "dsm", "red")


@query("z09_nearest", S + """, n AS (SELECT MAX(y) + 1 AS rows FROM scene),
target AS (SELECT CAST(a.x AS INT) AS x, CAST(b.y AS INT) AS y FROM range(100) a(x), (SELECT UNNEST(range(CAST(ROUND(rows / 0.4) AS INT))) AS y FROM n) b)
SELECT t.x, t.y, s.red FROM target t JOIN scene s ON s.x = FLOOR((t.x + 0.5) * 0.4::DOUBLE) AND s.y = FLOOR((t.y + 0.5) * 0.4::DOUBLE)""")
def nearest(spark, sf):
    px = fx.scene(spark, sf)
    return resample.to_resolution(px, ["red"], 1.0, 0.4, 40, rows_of(px), "nearest").drop("scene")


@query("z10_overview_average", S + """, n AS (SELECT MAX(x) + 1 AS w, MAX(y) + 1 AS h FROM scene)
SELECT x // 3 AS x, y // 3 AS y, ROUND(AVG(red), 6) AS red, ROUND(AVG(nir), 6) AS nir FROM scene, n
WHERE x // 3 < w // 3 AND y // 3 < h // 3 GROUP BY 1, 2""")
def overview_average(spark, sf):
    df = resample.overview(fx.scene(spark, sf), ["red", "nir"], resample.factor_for([3, 6], 1))
    return rounded(df.drop("scene"), "red", "nir")


@query("z10_overview_nearest", S + """, n AS (SELECT MAX(x) + 1 AS w, MAX(y) + 1 AS h FROM scene)
SELECT x // 4 AS x, y // 4 AS y, red FROM scene, n WHERE x % 4 = 2 AND y % 4 = 2 AND x // 4 < w // 4 AND y // 4 < h // 4""")
def overview_nearest(spark, sf):
    factor = resample.factor_for([2, 4], 3)
    return resample.overview(fx.scene(spark, sf), ["red"], factor, "nearest").drop("scene")


@query("z11_compare_levels", S + """, n AS (SELECT MAX(x) + 1 AS w, MAX(y) + 1 AS h FROM scene),
lv AS (SELECT * FROM (VALUES (0, 1), (1, 2), (2, 4), (3, 8)) t(level, factor))
SELECT level, factor, CAST(w // factor AS BIGINT) AS level_width, CAST(h // factor AS BIGINT) AS level_height,
    CAST((w // factor) * (h // factor) * 4 AS BIGINT) AS pixels,
    ROUND((w // factor) * (h // factor) * 16 / 1048576.0::DOUBLE, 6) AS size_mb,
    ROUND((w // factor) * (h // factor) * 100.0::DOUBLE / (w * h), 6) AS reduction_pct FROM n, lv""")
def compare_levels(spark, sf):
    return rounded(resample.compare_levels(fx.scene(spark, sf), [2, 4, 8]).drop("scene"), "size_mb", "reduction_pct")


@query("z12_survey_dates", fx.with_sql(fx.SURVEYS_SQL) + f"""SELECT year, COUNT(*) AS cells, ROUND(AVG({NDVI}), 6) AS ndvi
FROM surveys WHERE x BETWEEN 4 AND 30 AND y BETWEEN 10 AND 60 GROUP BY year""")
def survey_dates(spark, sf):
    index = indices.ndvi(c("nir"), c("red"))
    return rounded(composite.by_date(fx.surveys(spark, sf), index, "ndvi", (4.0, 10.0, 31.0, 61.0)), "ndvi")


@query("z12_survey_stack", fx.with_sql(fx.SURVEYS_SQL) + """SELECT x, y, MAX(nir) FILTER (year = '2017') AS nir_2017,
    MAX(nir) FILTER (year = '2020') AS nir_2020 FROM surveys GROUP BY x, y""")
def survey_stack(spark, sf):
    return composite.stack(fx.surveys(spark, sf), "nir", ["2017", "2020"])


@query("z13_world_coordinates", S + f"""SELECT x, y, {LEFT}::DOUBLE + (x + 0.5::DOUBLE) * {RES} AS world_x,
    {TOP}::DOUBLE - (y + 0.5::DOUBLE) * {RES} AS world_y FROM scene""")
def world(spark, sf):
    return resample.world(fx.scene(spark, sf), LEFT, TOP, RES, RES).select("x", "y", "world_x", "world_y")
