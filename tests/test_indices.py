"""Missing data, zero denominators and class limits."""

import math

from pyspark.sql import functions as F

from terraloom.functions import indices, tilemath
from terraloom.operators import algebra, stats, tiles

c = F.col


def frame(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def test_zero_denominator(spark):
    df = frame(spark, [(0.0, 0.0), (3.0, 1.0), (float("nan"), 1.0)], ["nir", "red"])
    got = df.select(indices.ndvi(c("nir"), c("red")), indices.ndvi(c("nir"), c("red"), "zero")).collect()
    assert [tuple(r) for r in got] == [(None, 0.0), (0.5, 0.5), (None, None)]


def test_masks_are_false_on_missing(spark):
    df = frame(spark, [(float("nan"),), (None,), (0.4,)], ["v"])
    got = df.select(indices.threshold_mask(c("v"), 0.3), indices.threshold_mask(c("v"), 0.3, False),
                    indices.height_mask(c("v"), 0.4, 0.4)).collect()
    assert [tuple(r) for r in got] == [(False, False, False), (False, False, False), (True, False, True)]


def test_height_keeps_missing(spark):
    df = frame(spark, [(1.0, 2.0), (5.0, 2.0), (None, 2.0)], ["dsm", "dem"])
    assert [r[0] for r in df.select(indices.height_above_ground(c("dsm"), c("dem"))).collect()] == [0.0, 3.0, None]


def test_landcover_limits(spark):
    rows = [(0.5, 60.0), (0.5, 10.0), (0.5, 3.5), (0.3, 10.0), (0.3, 1.0), (0.5, 50.0)]
    df = frame(spark, rows, ["v", "h"])
    got = [r[0] for r in df.select(indices.landcover(c("v"), c("h"), max_height=50.0)).collect()]
    assert got == [0, 3, 2, 1, 0, 3]


def test_hsv_colours(spark):
    rows = [("a", 255.0, 0.0, 0.0), ("a", 0.0, 255.0, 0.0), ("a", 0.0, 0.0, 255.0), ("a", 255.0, 0.0, 255.0), ("a", 0.0, 0.0, 0.0),
            ("b", 1.0, 1.0, 0.0), ("b", 0.5, 0.5, 0.5)]
    df = spark.createDataFrame(rows, "scene string, red double, green double, blue double")
    got = {tuple(r[:4]): tuple(r[4:]) for r in algebra.hsv(df).select("scene", "red", "green", "blue", "hue", "saturation", "value").collect()}
    assert [got[r] for r in rows] == [
        (0, 255, 255), (60, 255, 255), (120, 255, 255), (150, 255, 255), (0, 0, 0), (30, 255, 255), (0, 0, 127)]


def test_tile_form_equals_pixel_form(spark):
    nan = float("nan")
    t = spark.createDataFrame([
        ("a", 0, 0, 2, 2, [1.0, 2.0, nan, 0.0], [1.0, 1.0, 3.0, 0.0]), ("a", 1, 0, 2, 2, [5.0, 6.0, 7.0, 8.0], [8.0, 7.0, 6.0, 5.0]),
    ], "scene string, tx int, ty int, w int, h int, nir array<float>, red array<float>")
    arrow = t.select("scene", "tx", "ty", "w", "h", tilemath.ndvi().alias("v"), tilemath.ndvi(zero="zero").alias("z"))
    sql = t.select("scene", "tx", "ty", "w", "h", indices.over_arrays(indices.ndvi, c("nir"), c("red")).alias("v"),
                   indices.over_arrays(lambda n, r: indices.ndvi(n, r, "zero"), c("nir"), c("red")).alias("z"))
    def cells(df):
        rows = tiles.to_pixels(df, ["v", "z"], 2).collect()
        return sorted((r["x"], r["y"], *[None if q is None or math.isnan(q) else round(q, 6) for q in (r["v"], r["z"])]) for r in rows)
    assert cells(arrow) == cells(sql)


def test_histogram_leaves_out_of_range(spark):
    df = frame(spark, [(-1.0,), (0.0,), (0.4,), (255.4,), (256.0,), (float("nan"),)], ["v"])
    assert {tuple(r) for r in stats.histogram(df, "v").collect()} == {(0, 2), (255, 1)}


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.createDataFrame([("a", i % 7, i // 7, float(i)) for i in range(70)], "scene string, x int, y int, v double")
    one = stats.fingerprint(df, ["v"]).collect()
    assert stats.fingerprint(df.repartition(5).orderBy(F.desc("v")), ["v"]).collect() == one
    assert stats.fingerprint(df.withColumn("v", F.when(c("v") == 3, 4.0).otherwise(c("v"))), ["v"]).collect() != one
