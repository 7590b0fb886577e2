"""Assessment of raster headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Shares (percent) below which the report gives advice.
ADVICE = [
    ("cog_pct", 50, "Consider converting files to COG format for better performance"),
    ("tiled_pct", 80, "Consider tiling files for better random access"),
    ("overview_pct", 70, "Consider adding overviews for better performance at multiple scales"),
]
# Colour names by photometric code.
PHOTOMETRIC_NAMES = {0: "Gray", 1: "Gray", 2: "RGB", 3: "Palette", 5: "CMYK", 6: "YCbCr"}


def overview_factors(width: Column, widths: Column) -> Column:
    """Rounded half to even, at least 1; zero widths are skipped."""
    return F.transform(
        F.filter(widths, lambda w: w != 0),
        lambda w: F.greatest(F.bround(width / w).cast("int"), F.lit(1)),
    )


def bytes_per_cell(dtype: Column) -> Column:
    return F.when(dtype.contains("uint8"), 1).when(
        dtype.contains("uint16") | dtype.contains("float16"), 2
    ).otherwise(4)


def assess(headers: DataFrame) -> DataFrame:
    """Add overview factors, both COG tests, size estimate and bounds.

    ``is_cog_a``: blocks smaller than the raster, overviews, and the shorter
    block side within 256..1024.  ``is_cog_b``: stored in tiles and every band
    has overview factors.
    """
    c = F.col
    factors = overview_factors(c("width"), c("overview_widths"))
    df = headers.withColumns({
        "factors": factors,
        "is_tiled": (c("block_x") < c("width")) | (c("block_y") < c("height")),
        "has_overviews": F.coalesce(F.size("overview_widths"), F.lit(0)) > 0,
        "estimated_mb": c("width").cast("double") * c("height") * c("band_count")
        * bytes_per_cell(c("dtype")) / 1048576,
    })
    shorter = F.least("block_x", "block_y")
    return df.withColumns({
        "is_cog_a": c("is_tiled") & c("has_overviews") & shorter.between(256, 1024),
        "is_cog_b": (c("tiled") == "YES") & c("has_overviews") & (F.size("factors") > 0),
    })


def georeference(headers: DataFrame) -> DataFrame:
    """Bounds and resolution from ``transform`` (x_min, x_res, _, y_max, _, y_res)."""
    def t(i):
        return F.get("transform", F.lit(i))

    return headers.withColumns({
        "x_min": t(0), "y_max": t(3),
        "x_max": t(0) + F.col("width") * t(1), "y_min": t(3) + F.col("height") * t(5),
        "res_x": t(1), "res_y": F.abs(t(5)),
    })


def describe(headers: DataFrame) -> DataFrame:
    """One nested row per file: basic, bands, spatial, structure, size, errors."""
    df = georeference(assess(headers))
    names = F.create_map(*[F.lit(v) for pair in PHOTOMETRIC_NAMES.items() for v in pair])
    colour = F.try_element_at(names, F.col("photometric"))
    rgb = F.array(*[F.lit(n) for n in ("Red", "Green", "Blue")])
    band = F.transform(F.sequence(F.lit(1), F.coalesce("band_count", F.lit(1))), lambda i: F.struct(
        i.alias("index"), F.col("dtype").alias("dtype"), F.col("nodata").alias("nodata"),
        F.when(colour == "RGB", F.coalesce(F.get(rgb, i - 1), F.lit("Undefined")))
        .when(i == 1, colour).otherwise("Undefined").alias("color_interp"),
        F.array("block_x", "block_y").alias("block_size"), F.col("factors").alias("overviews"),
    ))
    return df.select(
        "path", F.col("error").isNull().alias("success"), "error",
        F.struct("driver", "width", "height", "band_count").alias("basic"),
        F.when(F.col("error").isNull(), band).alias("bands"),
        F.struct("epsg", "x_min", "y_min", "x_max", "y_max", "res_x", "res_y", "transform").alias("spatial"),
        F.struct("tiled", "compression", "interleave").alias("structure"),
        "metadata", "is_cog_a", "is_cog_b", (F.col("file_length") / 1048576).alias("file_size_mb"),
        "estimated_mb",
    )


def report(assessed: DataFrame, size_mb: str = "size_mb", cog: str = "is_cog_b") -> DataFrame:
    """Format summary in one pass: a total row, one per driver, one per compression."""
    # Both breakdowns and the total come from the same few partial sums.
    base = assessed.groupBy("driver", "compression").agg(
        F.count(F.lit(1)).alias("files"), F.sum(size_mb).alias("total_mb"),
        F.count_if(cog).alias("cog"), F.count_if(F.col("tiled") == "YES").alias("tiled"),
        F.count_if("has_overviews").alias("overview"),
    )
    sides = F.array(
        F.struct(F.lit("total").alias("part"), F.lit("").alias("name")),
        F.struct(F.lit("driver").alias("part"), F.coalesce("driver", F.lit("unknown")).alias("name")),
        F.struct(F.lit("compression").alias("part"), F.coalesce("compression", F.lit("unknown")).alias("name")),
    )
    summed = base.select("*", F.inline(sides)).groupBy("part", "name").agg(
        *[F.sum(n).alias(n) for n in ("files", "total_mb", "cog", "tiled", "overview")]
    )
    # The total is the largest of the few rows: the source is not read again.
    all_files = F.max("files").over(Window.partitionBy(F.lit(1)))
    return summed.select(
        "part", "name", "files", (F.col("files") / all_files * 100).alias("pct"), "total_mb",
        (F.col("total_mb") / F.col("files")).alias("mean_mb"),
        (F.col("cog") / F.col("files") * 100).alias("cog_pct"),
        (F.col("tiled") / F.col("files") * 100).alias("tiled_pct"),
        (F.col("overview") / F.col("files") * 100).alias("overview_pct"),
    )


def recommendations(report_df: DataFrame) -> DataFrame:
    """The advice that applies to the whole folder, one row each."""
    tips = F.array(*[
        F.when(F.col(share) < limit, F.lit(text)) for share, limit, text in ADVICE
    ])
    return report_df.filter(F.col("part") == "total").select(
        F.explode(F.filter(tips, lambda t: t.isNotNull())).alias("advice")
    )


def layout_kept(source: DataFrame, target: DataFrame, on: str = "name") -> DataFrame:
    """Compare compression, tiling and interleave of copies with their sources."""
    fields = [f for f in ("compression", "tiled", "interleave") if f in source.columns]
    a = source.select(on, *[F.col(f).alias(f"{f}_source") for f in fields])
    b = target.select(on, *[F.col(f).alias(f"{f}_target") for f in fields])
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"{f}_source").eqNullSafe(F.col(f"{f}_target"))
    return a.join(b, on).withColumn("kept", same)
