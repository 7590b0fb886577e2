"""Neighbourhood and workflow queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import indices, tilemath
from terraloom.operators import algebra, focal, halo, tiles
from terraloom.plans import workflows
from terraloom.suite import fixtures as fx
from terraloom.suite.grids import LAND, NDSM, NDVI, NDVI0, NDWI
from terraloom.suite.registry import query, rounded, six

c = F.col
S = fx.with_sql(fx.SCENE_SQL)
SQUARE = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
CROSS = [(0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)]


def step_sql(source, out, offsets, pick):
    """One dilation (MAX) or erosion (MIN) with absent cells as 0."""
    values = ", ".join(f"({a}, {b})" for a, b in offsets)
    return f"""{out} AS (SELECT a.x, a.y, {pick}(COALESCE(b.m, 0)) AS m
    FROM {source} a CROSS JOIN (VALUES {values}) o(dx, dy) LEFT JOIN {source} b ON b.x = a.x + o.dx AND b.y = a.y + o.dy
    GROUP BY a.x, a.y)"""


def closing_sql(source, out, offsets, iterations=1):
    parts, at = [], source
    for pick in ("MAX", "MIN"):
        for n in range(iterations):
            following = f"{out}_{pick.lower()}{n}"
            parts.append(step_sql(at, following, offsets, pick))
            at = following
    return ", ".join(parts) + f", {out} AS (SELECT * FROM {at})"


# Horn gradients by a full 3x3 kernel over clamped neighbours.
HORN = """, n AS (SELECT MAX(x) AS w, MAX(y) AS h FROM scene),
near AS (SELECT a.x, a.y, o.dx, o.dy, b.{band} AS v FROM scene a, n, (VALUES
    (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 0), (0, 1), (1, -1), (1, 0), (1, 1)) o(dx, dy)
    JOIN scene b ON b.x = LEAST(GREATEST(a.x + o.dx, 0), n.w) AND b.y = LEAST(GREATEST(a.y + o.dy, 0), n.h)),
grad AS (SELECT x, y, SUM(v * dx * (2 - ABS(dy))) / (8 * {rx}) AS gx, SUM(v * dy * (2 - ABS(dx))) / (8 * {ry}) AS gy
    FROM near GROUP BY x, y)
"""


def horn(band, rx=1.0, ry=1.0):
    return S + HORN.format(band=band, rx=rx, ry=ry)


@query("z01_horn_slope", horn("dsm") + "SELECT x, y, ROUND(DEGREES(ATAN(SQRT(gx * gx + gy * gy))), 6) AS slope FROM grad")
def horn_slope(spark, sf):
    px = fx.scene(spark, sf).select("scene", "x", "y", "dsm")
    return focal.slope(px, "dsm").select("x", "y", six("slope").alias("slope"))


@query("z01_horn_slope_tiles", horn("dem") + "SELECT x, y, ROUND(DEGREES(ATAN(SQRT(gx * gx + gy * gy))), 3) AS slope FROM grad")
def horn_slope_tiles(spark, sf):
    """Tile arrays are float32; the ground heights are exact in it."""
    long, size = tiled(fx.scene(spark, sf), "dem")
    return back(halo.slope(long, size), size, "slope").select("x", "y", F.round(c("slope").cast("double"), 3).alias("slope"))


@query("z02_slope_percent", horn("dsm", 0.5, 2.0) + """SELECT grad.x, grad.y,
    CASE WHEN grad.x > 0 AND grad.x < w AND grad.y > 0 AND grad.y < h THEN ROUND(100 * SQRT(gx * gx + gy * gy), 6) END AS slope FROM grad, n""")
def slope_percent(spark, sf):
    px = fx.scene(spark, sf).select("scene", "x", "y", "dsm")
    return focal.slope(px, "dsm", 0.5, 2.0, "percent", edge="null").select("x", "y", six("slope").alias("slope"))


@query("z02_slope_rise_run", horn("dem") + "SELECT x, y, ROUND(SQRT(gx * gx + gy * gy), 6) AS slope FROM grad")
def slope_rise(spark, sf):
    px = fx.scene(spark, sf).select("scene", "x", "y", "dem")
    return focal.slope(px, "dem", fmt="rise_run").select("x", "y", six("slope").alias("slope"))


@query("z03_gradient_slope", S + """, l AS (SELECT x, y, dsm AS v, LAG(dsm) OVER r AS l, LEAD(dsm) OVER r AS r,
    LAG(dsm) OVER d AS u, LEAD(dsm) OVER d AS d FROM scene
    WINDOW r AS (PARTITION BY y ORDER BY x), d AS (PARTITION BY x ORDER BY y)),
g AS (SELECT x, y, SQRT(POW((COALESCE(r, v) - COALESCE(l, v)) / CASE WHEN l IS NULL OR r IS NULL THEN 1 ELSE 2 END, 2)
    + POW((COALESCE(d, v) - COALESCE(u, v)) / CASE WHEN u IS NULL OR d IS NULL THEN 1 ELSE 2 END, 2)) AS slope FROM l)
SELECT x, y, ROUND(slope, 6) AS slope, CAST(CASE WHEN slope < 5 THEN 0 ELSE 1 END AS TINYINT) AS slope_class FROM g""")
def gradient_slope(spark, sf):
    px = focal.slope(fx.scene(spark, sf).select("scene", "x", "y", "dsm"), "dsm", method="gradient")
    return focal.classify_slope(px).select("x", "y", six("slope").alias("slope"), "slope_class")


@query("r10_slope_class", horn("dsm") + """SELECT x, y,
    CAST(CASE WHEN DEGREES(ATAN(SQRT(gx * gx + gy * gy))) < 60 THEN 0 ELSE 1 END AS TINYINT) AS slope_class FROM grad""")
def slope_class(spark, sf):
    px = focal.slope(fx.scene(spark, sf).select("scene", "x", "y", "dsm"), "dsm")
    return focal.classify_slope(px, 60.0).select("x", "y", "slope_class")


@query("a10_flat_share", horn("dsm") + """SELECT COUNT(*) AS cells, COUNT(*) FILTER (s < 60) AS flat_count,
    ROUND(COUNT(*) FILTER (s < 60) * 100.0::DOUBLE / COUNT(*), 6) AS flat_pct, COUNT(*) FILTER (s >= 60) AS sloped_count,
    ROUND(COUNT(*) FILTER (s >= 60) * 100.0::DOUBLE / COUNT(*), 6) AS sloped_pct
    FROM (SELECT DEGREES(ATAN(SQRT(gx * gx + gy * gy))) AS s FROM grad)""")
def flat_share(spark, sf):
    from terraloom.operators import stats

    px = focal.slope(fx.scene(spark, sf).select("scene", "x", "y", "dsm"), "dsm")
    df = stats.thresholds(px, {"flat": c("slope") < 60, "sloped": c("slope") >= 60})
    return rounded(df, "flat_pct", "sloped_pct")


TALL = f""", mask AS (SELECT x, y, CASE WHEN {NDVI} > {{value}} AND {NDSM} >= {{low}} {{high}} THEN 1 ELSE 0 END AS m FROM scene), """


@query("z04_select_by_height", S + TALL.format(value=0.1, low=1.0, high=f"AND {NDSM} <= 9") + closing_sql("mask", "closed", SQUARE)
       + "SELECT x, y, m = 1 AS selected FROM closed")
def select_by_height(spark, sf):
    px = algebra.ndsm(algebra.classify(algebra.ndvi(fx.scene(spark, sf)), value=0.1)).select(
        "scene", "x", "y", "mask", "ndsm")
    return focal.select_by_height(px, "mask", 1.0, 9.0).select("x", "y", "selected")


def class_closing_sql(iterations):
    parts = [fx.with_sql(LAND)]
    for k in (1, 2, 3):
        parts.append(f", m{k} AS (SELECT x, y, CASE WHEN class = {k} THEN 1 ELSE 0 END AS m FROM land), ")
        parts.append(closing_sql(f"m{k}", f"c{k}", CROSS, iterations))
    return "".join(parts) + """, cleaned AS (SELECT land.x, land.y, land.class, CAST(CASE WHEN c3.m = 1 THEN 3 WHEN c2.m = 1 THEN 2
    WHEN c1.m = 1 THEN 1 ELSE land.class END AS TINYINT) AS cleaned
FROM land JOIN c1 ON c1.x = land.x AND c1.y = land.y JOIN c2 ON c2.x = land.x AND c2.y = land.y
JOIN c3 ON c3.x = land.x AND c3.y = land.y)
"""


def classes(spark, sf):
    px = algebra.landcover(algebra.ndsm(algebra.ndvi(fx.scene(spark, sf), zero="zero")))
    return px.select("scene", "x", "y", "class")


@query("z05_clean_classes_once", class_closing_sql(1) + "SELECT x, y, class, cleaned FROM cleaned")
def clean_once(spark, sf):
    return focal.clean_classes(classes(spark, sf), iterations=1).drop("scene")


@query("z05_clean_classes", class_closing_sql(2) + "SELECT x, y, class, cleaned FROM cleaned")
def clean_twice(spark, sf):
    return focal.clean_classes(classes(spark, sf)).drop("scene")


def tiled(px, band, size=32):
    """Long tiles of one band, as the tile operators take them."""
    return tiles.by_band(tiles.from_pixels(px, [band], size), [band]), size


def back(long, size, name):
    wide = long.select("scene", "tx", "ty", F.lit(size).alias("w"), F.lit(size).alias("h"), c("data").alias(name))
    return tiles.to_pixels(wide, [name], size).filter(c(name).isNotNull())


@query("z05_clean_classes_tiles", class_closing_sql(2) + "SELECT x, y, cleaned FROM cleaned")
def clean_tiles(spark, sf):
    long, size = tiled(classes(spark, sf), "class")
    # Cells beyond the scene's edge are NaN in the last tiles and stay NaN.
    return back(halo.clean_classes(long, size), size, "cleaned").select("x", "y", c("cleaned").cast("tinyint").alias("cleaned"))


@query("r09_landcover_tiles", fx.with_sql(LAND) + "SELECT x, y, class, class_capped FROM land")
def landcover_tiles(spark, sf):
    t = fx.tiles(spark, sf).select(
        "scene", "tx", "ty", "w", "h", tilemath.landcover().alias("class"), tilemath.landcover(max_height=8.0).alias("class_capped"))
    px = tiles.to_pixels(t, ["class", "class_capped"], fx.SIZE)
    return px.select("x", "y", *[c(n).cast("tinyint").alias(n) for n in ("class", "class_capped")])


@query("z06_fill_holes", S + TALL.format(value=0.35, low=3.5, high="") + """
reach AS (SELECT dx, dy FROM (SELECT UNNEST(range(-10, 11)) AS dx), (SELECT UNNEST(range(-10, 11)) AS dy) WHERE dx * dx + dy * dy <= 100),
touched AS (SELECT DISTINCT m.x + dx AS x, m.y + dy AS y FROM mask m, reach WHERE m.m = 1)
SELECT mask.x, mask.y, CAST(CASE WHEN touched.x IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS filled
FROM mask LEFT JOIN touched ON touched.x = mask.x AND touched.y = mask.y""")
def fill_holes(spark, sf):
    px = algebra.ndsm(algebra.ndvi(fx.scene(spark, sf)))
    held = indices.vegetation_mask(c("ndvi")) & indices.height_mask(c("ndsm"), 3.5)
    long, size = tiled(px.select("scene", "x", "y", held.cast("int").alias("veg")), "veg")
    filled = back(halo.fill_holes(long, size), size, "filled").join(px.select("x", "y"), ["x", "y"], "left_semi")
    return filled.select("x", "y", six(c("filled").cast("double")).alias("filled"))


@query("z07_halo_mean", S + """SELECT a.x, a.y, ROUND(AVG(b.red), 3) AS mean FROM scene a, (VALUES
    (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 0), (0, 1), (1, -1), (1, 0), (1, 1)) o(dx, dy)
    JOIN scene b ON b.x = a.x + o.dx AND b.y = a.y + o.dy GROUP BY a.x, a.y""")
def halo_mean(spark, sf):
    long = tiles.by_band(fx.tiles(spark, sf).select("scene", "tx", "ty", "w", "h", "red"), ["red"])
    return back(halo.mean3(long, fx.SIZE), fx.SIZE, "mean").select(
        "x", "y", F.round(c("mean").cast("double"), 3).alias("mean"))


# ---- workflows ------------------------------------------------------------

VEGETATION = S + TALL.format(value=0.35, low=3.5, high="") + closing_sql("mask", "closed", SQUARE)


@query("x01_vegetation", VEGETATION + "SELECT x, y, CAST(m AS TINYINT) AS vegetation FROM closed")
def vegetation(spark, sf):
    return workflows.vegetation(fx.scene(spark, sf)).drop("scene")


@query("x01_vegetation_tiles", VEGETATION + "SELECT x, y, CAST(m AS TINYINT) AS vegetation FROM closed")
def vegetation_tiles(spark, sf):
    long = workflows.vegetation_tiles(fx.tiles(spark, sf), fx.SIZE)
    return back(long, fx.SIZE, "vegetation").select("x", "y", c("vegetation").cast("tinyint").alias("vegetation"))


GENERAL = S + f""", mask AS (SELECT x, y, {NDWI} AS w, {NDSM} AS h, CASE WHEN {NDWI} < 0.2 AND {NDSM} >= 1 AND {NDSM} <= 12 THEN 1 ELSE 0 END AS m,
    COALESCE({NDWI} < 0.2, FALSE) AS raw FROM scene), """ + closing_sql("mask", "closed", SQUARE)


@query("x02_general", GENERAL + "SELECT x, y, CAST(m AS TINYINT) AS selected FROM closed")
def general(spark, sf):
    return workflows.general(fx.scene(spark, sf), 1.0, 12.0, False, 0.2, "ndwi").drop("scene")


@query("x02_general_flat", S + f"SELECT x, y, CAST(CASE WHEN {NDVI} > 0.3 THEN 1 ELSE 0 END AS TINYINT) AS selected FROM scene")
def general_flat(spark, sf):
    return workflows.general(fx.scene(spark, sf), use_height=False).drop("scene")


@query("k05_kept_steps", GENERAL + """SELECT closed.x, closed.y, ROUND(w, 6) AS ndwi, ROUND(h, 6) AS ndsm, raw AS mask,
    CAST(closed.m AS TINYINT) AS selected FROM closed JOIN mask ON mask.x = closed.x AND mask.y = closed.y""")
def kept_steps(spark, sf):
    df = workflows.general(fx.scene(spark, sf), 1.0, 12.0, False, 0.2, "ndwi", keep_steps=True)
    return rounded(df.drop("scene"), "ndwi", "ndsm")


LANDRUN = class_closing_sql(2) + HORN.format(band="dem", rx=1.0, ry=1.0) + """, cells AS (SELECT cleaned.x, cleaned.y, v AS ndvi, h AS ndsm, cleaned.class, cleaned,
    DEGREES(ATAN(SQRT(gx * gx + gy * gy))) AS slope FROM cleaned JOIN land ON land.x = cleaned.x AND land.y = cleaned.y
    JOIN grad ON grad.x = cleaned.x AND grad.y = cleaned.y)
"""


@query("x03_landcover", LANDRUN + """SELECT x, y, ROUND(ndvi, 6) AS ndvi, ROUND(ndsm, 6) AS ndsm, class, cleaned, ROUND(slope, 6) AS slope,
    CAST(CASE WHEN slope < 5 THEN 0 ELSE 1 END AS TINYINT) AS slope_class FROM cells""")
def landcover(spark, sf):
    return rounded(workflows.landcover(fx.scene(spark, sf)).drop("scene"), "ndvi", "ndsm", "slope")


@query("x03_landcover_summary", LANDRUN + """SELECT COUNT(*) AS cells, ROUND(MIN(ndvi), 6) AS ndvi_min, ROUND(MAX(ndvi), 6) AS ndvi_max,
    ROUND(AVG(ndvi), 6) AS ndvi_mean, ROUND(STDDEV_POP(ndvi), 6) AS ndvi_std, COUNT(*) FILTER (ndvi > 0.3) AS vegetation,
    COUNT(*) FILTER (ndvi > 0.5) AS healthy, ROUND(MAX(ndsm), 6) AS height_max, ROUND(AVG(ndsm), 6) AS height_mean,
    ROUND(STDDEV_POP(ndsm), 6) AS height_std, COUNT(*) FILTER (ndsm > 3) AS above_3m, COUNT(*) FILTER (ndsm > 10) AS above_10m,
    ROUND(COUNT(*) FILTER (slope < 5) * 100.0::DOUBLE / COUNT(*), 6) AS flat_pct, COUNT(*) FILTER (class <> cleaned) AS changed,
    COUNT(*) FILTER (cleaned = 0) AS class_0, COUNT(*) FILTER (cleaned = 1) AS class_1,
    COUNT(*) FILTER (cleaned = 2) AS class_2, COUNT(*) FILTER (cleaned = 3) AS class_3 FROM cells""")
def landcover_summary(spark, sf):
    df = workflows.landcover_summary(workflows.landcover(fx.scene(spark, sf)))
    return rounded(df, "ndvi_min", "ndvi_max", "ndvi_mean", "ndvi_std", "height_max", "height_mean", "height_std", "flat_pct")
