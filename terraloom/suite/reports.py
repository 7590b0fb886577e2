"""Raster header assessment and outcome reports."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from terraloom.operators import inventory, resample, transfer
from terraloom.plans import catalogue as plans
from terraloom.suite import fixtures as fx
from terraloom.suite.registry import query, rounded, six

c = F.col
H = fx.with_sql(fx.HEADERS_SQL + """,
assessed AS (SELECT *, CASE WHEN block_x < width THEN 'YES' ELSE 'NO' END AS tiled,
    block_x < width OR block_y < height AS is_tiled, overview_count > 0 AS has_overviews,
    (block_x < width OR block_y < height) AND overview_count > 0 AND LEAST(block_x, block_y) BETWEEN 256 AND 1024 AS is_cog_a,
    block_x < width AND overview_count > 0 AS is_cog_b FROM headers)""")


def assessed(spark, sf):
    return inventory.assess(fx.raster_headers(spark, sf))


@query("q01_cog_test_a", H + "SELECT file_id, is_tiled, has_overviews, is_cog_a FROM assessed")
def cog_a(spark, sf):
    return assessed(spark, sf).select("file_id", "is_tiled", "has_overviews", "is_cog_a")


@query("q02_cog_test_b", H + "SELECT file_id, tiled, is_cog_b FROM assessed")
def cog_b(spark, sf):
    return assessed(spark, sf).select("file_id", "tiled", "is_cog_b")


@query("q03_overview_factors", H + """SELECT file_id, CAST(GREATEST(1, ROUND_EVEN(width / FLOOR(width / pow(2, k)), 0)) AS INT) AS factor
FROM (SELECT file_id, width, UNNEST(range(1, overview_count + 1)) AS k FROM assessed)""")
def factors(spark, sf):
    return assessed(spark, sf).select("file_id", F.explode("factors").alias("factor"))


@query("q04_estimated_size", H + """SELECT file_id, ROUND(CAST(width AS DOUBLE) * height * band_count
    * CASE dtype WHEN 'uint8' THEN 1 WHEN 'uint16' THEN 2 ELSE 4 END / 1048576, 6) AS estimated_mb FROM assessed""")
def estimated(spark, sf):
    return rounded(assessed(spark, sf).select("file_id", "estimated_mb"), "estimated_mb")


@query("q07_layout_kept", H + """SELECT name, compression AS compression_source, CASE WHEN status = 'copied' THEN compression ELSE 'NONE' END AS compression_target,
    tiled AS tiled_source, tiled AS tiled_target, status = 'copied' OR compression = 'NONE' AS kept FROM assessed""")
def layout(spark, sf):
    source = fx.raster_headers(spark, sf)
    target = source.withColumn("compression", F.when(c("status") == "copied", c("compression")).otherwise("NONE"))
    return inventory.layout_kept(source, target)


@query("z13_bounds", H + """SELECT file_id, 1000000.0::DOUBLE + file_id AS x_min, 5000000.0::DOUBLE AS y_max,
    1000000.0::DOUBLE + file_id + width * 0.5 AS x_max, 5000000.0::DOUBLE - height * 0.25 AS y_min, 0.5::DOUBLE AS res_x, 0.25::DOUBLE AS res_y FROM assessed""")
def bounds(spark, sf):
    df = fx.raster_headers(spark, sf).withColumn("transform", F.array(
        1000000.0 + c("file_id"), F.lit(0.5), F.lit(0.0), F.lit(5000000.0), F.lit(0.0), F.lit(-0.25)))
    return inventory.georeference(df).select("file_id", "x_min", "y_max", "x_max", "y_min", "res_x", "res_y")


def share(condition):
    return f"ROUND(COUNT(*) FILTER ({condition}) * 100.0::DOUBLE / COUNT(*), 6)"


REPORT = f"""COUNT(*) AS files, ROUND(COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM assessed), 6) AS pct,
    ROUND(SUM(size_mb), 6) AS total_mb, ROUND(AVG(size_mb), 6) AS mean_mb, {share('is_cog_b')} AS cog_pct,
    {share("tiled = 'YES'")} AS tiled_pct, {share('has_overviews')} AS overview_pct FROM assessed"""
REPORT_SQL = H + f"""SELECT 'total' AS part, '' AS name, {REPORT} UNION ALL
SELECT 'driver', driver, {REPORT} GROUP BY driver UNION ALL SELECT 'compression', compression, {REPORT} GROUP BY compression"""


def report(spark, sf):
    df = plans.health(fx.raster_headers(spark, sf))
    return rounded(df, "pct", "mean_mb", "cog_pct", "tiled_pct", "overview_pct", "total_mb")


@query("a17_format_summary", REPORT_SQL)
def format_summary(spark, sf):
    return report(spark, sf)


@query("a18_recommendations", H + f"""SELECT advice FROM (SELECT {share('is_cog_b')} AS a, {share("tiled = 'YES'")} AS b, {share('has_overviews')} AS d FROM assessed),
    LATERAL (SELECT CASE WHEN a < 50 THEN 'Consider converting files to COG format for better performance' END AS advice
    UNION ALL SELECT CASE WHEN b < 80 THEN 'Consider tiling files for better random access' END
    UNION ALL SELECT CASE WHEN d < 70 THEN 'Consider adding overviews for better performance at multiple scales' END) WHERE advice IS NOT NULL""")
def recommendations(spark, sf):
    return inventory.recommendations(plans.health(fx.raster_headers(spark, sf)))


@query("x07_health_report", H + f"SELECT driver, {REPORT} GROUP BY driver")
def health(spark, sf):
    return report(spark, sf).filter(c("part") == "driver").drop("part").withColumnRenamed("name", "driver")


@query("l05_sorted_formats", H + "SELECT driver, compression, COUNT(*) AS files FROM assessed GROUP BY driver, compression ORDER BY driver, compression")
def sorted_formats(spark, sf):
    return fx.raster_headers(spark, sf).groupBy("driver", "compression").agg(
        F.count(F.lit(1)).alias("files")).orderBy("driver", "compression")


@query("v02_share_of_total", H + """SELECT compression, COUNT(*) AS files, ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS pct
FROM assessed GROUP BY compression""")
def share_of_total(spark, sf):
    # The window runs over one row per format, after the aggregation.
    counts = fx.raster_headers(spark, sf).groupBy("compression").agg(F.count(F.lit(1)).alias("files"))
    total = F.sum("files").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", six(c("files") / total * 100))


@query("a19_outcome_summary", H + "SELECT status, COUNT(*) AS files, ROUND(SUM(size_mb), 6) AS total_mb, ROUND(SUM(size_mb) / SUM(width / 1024), 6) AS mb_per_second FROM assessed GROUP BY status")
def outcome(spark, sf):
    status = fx.raster_headers(spark, sf).withColumn("seconds", c("width") / 1024)
    return rounded(transfer.summary(status, seconds="seconds"), "mb_per_second", "total_mb")


@query("a20_success_by_prefix", H + "SELECT driver AS prefix, COUNT(*) FILTER (status <> 'failed') AS succeeded, COUNT(*) AS files FROM assessed GROUP BY driver")
def success(spark, sf):
    return transfer.by_prefix(fx.raster_headers(spark, sf).withColumnRenamed("driver", "prefix"))
