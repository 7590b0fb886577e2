"""Inputs of the registered queries, derived from the driver's tables.

Each fixture exists twice: as a Spark frame and as DuckDB text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BANDS = ["red", "green", "blue", "nir", "dsm", "dem"]
SIZE = 8
BUCKET, REGION = "imagery-bucket", "region-1"
BASE = f"https://{BUCKET}.s3.{REGION}.amazonaws.com"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tiles(spark: SparkSession, sf: str) -> DataFrame:
    """A dense scene as wide 8 x 8 tiles, 5 tiles across.

    Each embedding is one band of one tile; zero cells lie on every 17th
    diagonal; the height comes from the green values.
    """
    c = F.col
    e = table(spark, sf, "embeddings").select(
        F.floor(c("vec_id") / 4).alias("tile"), (c("vec_id") % 4).alias("band"), "embedding"
    )
    # One row per tile: the four arrays meet in one small aggregation.
    t = e.groupBy("tile").agg(*[
        F.max(F.when(c("band") == n, c("embedding"))).alias(f"e{n}") for n in range(4)
    ]).select(
        F.when(c("tile") >= 0, "a").alias("scene"), (c("tile") % 5).cast("int").alias("tx"),
        F.floor(c("tile") / 5).cast("int").alias("ty"), F.lit(SIZE).alias("w"), F.lit(SIZE).alias("h"),
        *[f"e{n}" for n in range(4)],
    )

    def x(i):
        return c("tx") * SIZE + i % SIZE

    def y(i):
        return c("ty") * SIZE + F.floor(i / SIZE)

    def number(v, i):
        dn = F.least(F.greatest(F.floor((v.cast("double") + 0.4) * 320), F.lit(0)), F.lit(255))
        return F.when((x(i) + y(i)) % 17 == 0, F.lit(0.0)).otherwise(dn.cast("double"))

    ground = lambda i: 100.0 + 0.25 * x(i) + 0.125 * y(i)
    return t.select(
        "scene", "tx", "ty", "w", "h",
        *[F.transform(f"e{n}", number).alias(b) for n, b in enumerate(BANDS[:4])],
        F.transform("e1", lambda v, i: ground(i) - 0.5 + F.greatest(F.lit(0.0), 40.0 * v.cast("double"))).alias("dsm"),
        F.transform("e1", lambda v, i: ground(i)).alias("dem"),
    )


def stored_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles as files store them: those with any band; cells of a band that a tile lacks are missing but for the diagonals."""
    c = F.col
    at = F.sequence(F.lit(0), F.lit(SIZE * SIZE - 1))
    x, y = (lambda i: c("tx") * SIZE + i % SIZE), (lambda i: c("ty") * SIZE + F.floor(i / SIZE))
    ground = lambda i: 100.0 + 0.25 * x(i) + 0.125 * y(i)
    return tiles(spark, sf).filter(F.coalesce(*BANDS[:4]).isNotNull()).withColumns({
        **{b: F.coalesce(b, F.transform(at, lambda i: F.when((x(i) + y(i)) % 17 == 0, 0.0))) for b in BANDS[:4]},
        "dsm": F.coalesce("dsm", F.transform(at, lambda i: ground(i) - 0.5)), "dem": F.coalesce("dem", F.transform(at, ground)),
    })


def scene(spark: SparkSession, sf: str) -> DataFrame:
    """The same scene as pixel rows."""
    from terraloom.operators import tiles as tile_ops

    return tile_ops.to_pixels(tiles(spark, sf), BANDS, SIZE)


SCENE_SQL = """
scene_e AS (SELECT vec_id, UNNEST(embedding) AS v, UNNEST(range(len(embedding))) AS i FROM embeddings),
scene_cell AS (SELECT CAST(vec_id % 4 AS INT) AS band,
    CAST(((vec_id // 4) % 5) * 8 + i % 8 AS INT) AS x,
    CAST(((vec_id // 4) // 5) * 8 + i // 8 AS INT) AS y, CAST(v AS DOUBLE) AS v FROM scene_e),
scene_dn AS (SELECT band, x, y, v,
    CAST(LEAST(GREATEST(FLOOR((v + 0.4::DOUBLE) * 320), 0), 255) AS DOUBLE) AS q FROM scene_cell),
scene AS (SELECT x, y,
    CASE WHEN (x + y) % 17 = 0 THEN 0.0::DOUBLE ELSE MAX(CASE WHEN band = 0 THEN q END) END AS red,
    CASE WHEN (x + y) % 17 = 0 THEN 0.0::DOUBLE ELSE MAX(CASE WHEN band = 1 THEN q END) END AS green,
    CASE WHEN (x + y) % 17 = 0 THEN 0.0::DOUBLE ELSE MAX(CASE WHEN band = 2 THEN q END) END AS blue,
    CASE WHEN (x + y) % 17 = 0 THEN 0.0::DOUBLE ELSE MAX(CASE WHEN band = 3 THEN q END) END AS nir,
    100.0::DOUBLE + 0.25::DOUBLE * x + 0.125::DOUBLE * y AS dem,
    99.5::DOUBLE + 0.25::DOUBLE * x + 0.125::DOUBLE * y
        + GREATEST(0.0::DOUBLE, 40.0::DOUBLE * MAX(CASE WHEN band = 1 THEN v END)) AS dsm
    FROM scene_dn GROUP BY x, y)
"""


def surveys(spark: SparkSession, sf: str) -> DataFrame:
    """Two dates of the scene."""
    first = scene(spark, sf)
    return first.withColumn("year", F.lit("2017")).unionByName(
        first.withColumn("nir", F.col("nir") * 3 % 256).withColumn("year", F.lit("2020"))
    )


SURVEYS_SQL = SCENE_SQL + """,
surveys AS (SELECT '2017' AS year, x, y, red, green, blue, nir, dem, dsm FROM scene UNION ALL
    SELECT '2020', x, y, red, green, blue, (nir * 3) % 256, dem, dsm FROM scene)
"""


def strips(spark: SparkSession, sf: str) -> DataFrame:
    """A sparse scene with overlapping rows, before the mosaic."""
    c = F.col
    return table(spark, sf, "lineitem").select(
        c("l_returnflag").alias("scene"), (c("l_linenumber") - 1).alias("x"), c("l_orderkey").alias("y"),
        c("l_quantity").alias("red"), F.floor(c("l_extendedprice") / 512).cast("double").alias("green"),
        F.floor(c("l_discount") * 1000).cast("double").alias("blue"),
        F.floor(c("l_tax") * 2000).cast("double").alias("nir"),
    )


STRIPS_SQL = """
strips AS (SELECT l_returnflag AS scene, l_linenumber - 1 AS x, l_orderkey AS y, l_quantity AS red,
    FLOOR(l_extendedprice / 512) AS green, FLOOR(l_discount * 1000) AS blue, FLOOR(l_tax * 2000) AS nir
    FROM lineitem)
"""


def links(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue links: 1 in 13 is no child, 1 in 11 has a short path."""
    c = F.col
    k = c("p_partkey")
    head = F.concat(F.lit("./"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")), F.lit("/"),
                    F.replace(c("p_name"), F.lit(" "), F.lit("-")))
    year = 1990 + c("p_size") % 30
    second = F.when(k % 3 == 0, F.concat(F.lit("-"), (year + 1).cast("string"))).otherwise("")
    res = F.when(k % 5 == 0, "0.06").when(k % 5 == 1, "0.075").when(k % 5 == 2, "0.1").when(
        k % 5 == 3, "0.125").otherwise("0.4")
    kind = F.when(k % 3 == 0, "rgb").when(k % 3 == 1, "rgbnir").otherwise("dem_1m")
    return table(spark, sf, "part").select(
        k.alias("seq"), F.when(k % 13 == 0, "self").otherwise("child").alias("rel"), c("p_name").alias("title"),
        F.when(k % 11 == 0, F.concat(head, F.lit("/collection.json"))).otherwise(F.concat(
            head, F.lit("_"), year.cast("string"), second, F.lit("_"), res, F.lit("m/"), kind,
            F.lit("/2193/collection.json"))).alias("href"),
    )


LINKS_SQL = """
links AS (SELECT p_partkey AS seq, CASE WHEN p_partkey % 13 = 0 THEN 'self' ELSE 'child' END AS rel, p_name AS title,
    CASE WHEN p_partkey % 11 = 0
      THEN './' || REPLACE(LOWER(p_brand), '#', '-') || '/' || REPLACE(p_name, ' ', '-') || '/collection.json'
      ELSE './' || REPLACE(LOWER(p_brand), '#', '-') || '/' || REPLACE(p_name, ' ', '-')
        || '_' || CAST(1990 + p_size % 30 AS VARCHAR)
        || CASE WHEN p_partkey % 3 = 0 THEN '-' || CAST(1991 + p_size % 30 AS VARCHAR) ELSE '' END
        || '_' || CASE p_partkey % 5 WHEN 0 THEN '0.06' WHEN 1 THEN '0.075' WHEN 2 THEN '0.1'
                       WHEN 3 THEN '0.125' ELSE '0.4' END || 'm/'
        || CASE p_partkey % 3 WHEN 0 THEN 'rgb' WHEN 1 THEN 'rgbnir' ELSE 'dem_1m' END
        || '/2193/collection.json' END AS href
    FROM part)
"""

# The whole collections table in SQL, worked out separately from the library.
COLLECTIONS_SQL = LINKS_SQL + f""",
href_clean AS (SELECT seq, rel, title, href, REPLACE(REPLACE(href, './', ''), '/collection.json', '') AS whole FROM links),
href_parts AS (SELECT *, string_split(whole, '/') AS p FROM href_clean),
href_folder AS (SELECT *, len(p) >= 3 AS deep,
    CASE WHEN len(p) >= 3 THEN array_to_string(p[1:len(p) - 2], '/') ELSE whole END AS folder FROM href_parts),
href_text AS (SELECT *,
    CASE WHEN deep THEN regexp_extract(folder, '_(\\d{{4}}(?:-\\d{{4}})?)_', 1) ELSE '' END AS years,
    CASE WHEN deep THEN regexp_extract(folder, '_(\\d+\\.?\\d*m)(?:/|$)', 1) ELSE '' END AS res FROM href_folder),
collections AS (SELECT seq, rel, href, title, folder AS path, REPLACE(p[1], '-', ' ') AS region,
    REPLACE(string_split(p[2], '_')[1], '-', ' ') AS sub_region,
    CASE WHEN deep THEN p[len(p) - 1] ELSE '' END AS type, CASE WHEN deep THEN p[len(p)] ELSE '' END AS crs,
    string_split(years, '-')[1] AS base_year, years AS year_range,
    CASE WHEN res = '' THEN '' ELSE CAST(CAST(REPLACE(res, 'm', '') AS DOUBLE) * 100 AS VARCHAR) END AS cellsize_cm,
    res AS gsd, 's3://{BUCKET}/' || whole || '/' AS s3, '{BASE}/' || whole || '/' AS https
    FROM href_text)
"""


def items(spark: SparkSession, sf: str) -> DataFrame:
    """Items with boxes: 1 in 19 has none; a collection holds one customer's orders."""
    c = F.col
    o, k = c("o_orderkey"), c("o_custkey")

    def box(value):
        return F.when(o % 19 != 0, value.cast("double"))

    href = F.when(o % 3 == 0, F.concat(F.lit("./"), o.cast("string"), F.lit(".json"))).when(
        o % 3 == 1, F.concat(F.lit("https://host/a/b/"), o.cast("string"), F.lit(".json"))
    ).otherwise(F.concat(o.cast("string"), F.lit(".json")))
    return table(spark, sf, "orders").select(
        o.cast("string").alias("item_id"), k.alias("collection_seq"),
        box(1000000 + o % 400 * 240).alias("minx"), box(5000000 + k % 300 * 360).alias("miny"),
        box(1000240 + o % 400 * 240).alias("maxx"), box(5000360 + k % 300 * 360).alias("maxy"),
        c("o_orderdate").alias("acquired"),
        F.when(c("o_orderpriority").startswith("1"), "visual").otherwise("red,green,blue,nir").alias("asset_types"),
        href.alias("item_href"),
    )


ITEMS_SQL = """
items AS (SELECT CAST(o_orderkey AS VARCHAR) AS item_id, o_custkey AS collection_seq,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(1000000 + (o_orderkey % 400) * 240 AS DOUBLE) END AS minx,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(5000000 + (o_custkey % 300) * 360 AS DOUBLE) END AS miny,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(1000240 + (o_orderkey % 400) * 240 AS DOUBLE) END AS maxx,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(5000360 + (o_custkey % 300) * 360 AS DOUBLE) END AS maxy,
    o_orderdate AS acquired,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'visual' ELSE 'red,green,blue,nir' END AS asset_types,
    CASE o_orderkey % 3 WHEN 0 THEN './' || CAST(o_orderkey AS VARCHAR) || '.json'
      WHEN 1 THEN 'https://host/a/b/' || CAST(o_orderkey AS VARCHAR) || '.json'
      ELSE CAST(o_orderkey AS VARCHAR) || '.json' END AS item_href
    FROM orders)
"""


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of interest: one box per customer, of very different sizes."""
    k = F.col("c_custkey")
    side = F.lit(200.0) * F.pow(F.lit(2.0), (k % 6).cast("double"))
    return table(spark, sf, "customer").select(
        k.alias("b_id"), (1000000.0 + k % 97 * 1000).alias("b_minx"), (5000000.0 + k % 89 * 1200).alias("b_miny"),
        (1000000.0 + k % 97 * 1000 + side).alias("b_maxx"), (5000000.0 + k % 89 * 1200 + side).alias("b_maxy"),
    )


AREAS_SQL = """
areas AS (SELECT c_custkey AS b_id,
    1000000.0::DOUBLE + c_custkey % 97 * 1000 AS b_minx, 5000000.0::DOUBLE + c_custkey % 89 * 1200 AS b_miny,
    1000000.0::DOUBLE + c_custkey % 97 * 1000 + 200.0::DOUBLE * pow(2, c_custkey % 6) AS b_maxx,
    5000000.0::DOUBLE + c_custkey % 89 * 1200 + 200.0::DOUBLE * pow(2, c_custkey % 6) AS b_maxy FROM customer)
"""


def keys(spark: SparkSession, sf: str) -> DataFrame:
    """Object keys and urls of the pages."""
    k = F.col("page_id")
    ext = F.when(k % 6 == 1, ".tiff").when(k % 6 == 2, ".TIF").when(k % 6 == 3, ".jpg").when(
        k % 6 == 4, ".json").otherwise(".txt")
    return table(spark, sf, "pages").select(
        "page_id", "url",
        F.when(k % 6 == 0, "catalog.json").otherwise(F.concat(
            F.lit("r"), (k % 9).cast("string"), F.lit("/t"), k.cast("string"), ext)).alias("key"),
        F.length("html").cast("bigint").alias("length"),
    )


KEYS_SQL = """
keys AS (SELECT page_id, url, CASE page_id % 6 WHEN 0 THEN 'catalog.json'
    ELSE 'r' || CAST(page_id % 9 AS VARCHAR) || '/t' || CAST(page_id AS VARCHAR)
      || CASE page_id % 6 WHEN 1 THEN '.tiff' WHEN 2 THEN '.TIF' WHEN 3 THEN '.jpg' WHEN 4 THEN '.json' ELSE '.txt' END
    END AS key, CAST(LENGTH(html) AS BIGINT) AS length FROM pages)
"""


def raster_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Header and copy-status rows."""
    c = F.col
    k, s = c("p_partkey"), c("p_size")
    base = table(spark, sf, "part").select(
        k.alias("file_id"), F.concat(F.lit("f"), k.cast("string"), F.lit(".tif")).alias("name"),
        F.when(k % 7 == 0, "PNG").otherwise("GTiff").alias("driver"), c("p_type").alias("compression"),
        (4096 + s * 64).alias("width"), (2048 + s * 32).alias("height"), (3 + k % 3).cast("int").alias("band_count"),
        F.when(k % 3 == 0, "uint8").when(k % 3 == 1, "uint16").otherwise("float32").alias("dtype"),
        F.when(k % 4 == 0, 256).when(k % 4 == 1, 512).when(k % 4 == 2, 2048).otherwise(4096 + s * 64).alias("block_x"),
        F.when(k % 4 == 0, 256).when(k % 4 == 1, 512).when(k % 4 == 2, 2048).otherwise(1).alias("block_y"),
        F.when(s % 2 == 0, 0).otherwise(1 + s % 5).alias("overview_count"),
        (F.round(c("p_retailprice") * 100) / 64).alias("size_mb"),
        F.when(k % 10 == 9, "failed").when(k % 10 == 8, "skipped").otherwise("copied").alias("status"),
    )
    return base.withColumns({
        "tiled": F.when(c("block_x") < c("width"), "YES").otherwise("NO"),
        "overview_widths": F.when(c("overview_count") > 0, F.transform(
            F.sequence(F.lit(1), c("overview_count")),
            lambda n: F.floor(c("width") / F.pow(F.lit(2.0), n.cast("double"))).cast("int")))
        .otherwise(F.array().cast("array<int>")),
    })


HEADERS_SQL = """
headers AS (SELECT p_partkey AS file_id, 'f' || CAST(p_partkey AS VARCHAR) || '.tif' AS name,
    CASE p_partkey % 7 WHEN 0 THEN 'PNG' ELSE 'GTiff' END AS driver, p_type AS compression,
    4096 + p_size * 64 AS width, 2048 + p_size * 32 AS height, CAST(3 + p_partkey % 3 AS INT) AS band_count,
    CASE p_partkey % 3 WHEN 0 THEN 'uint8' WHEN 1 THEN 'uint16' ELSE 'float32' END AS dtype,
    CASE p_partkey % 4 WHEN 0 THEN 256 WHEN 1 THEN 512 WHEN 2 THEN 2048 ELSE 4096 + p_size * 64 END AS block_x,
    CASE p_partkey % 4 WHEN 0 THEN 256 WHEN 1 THEN 512 WHEN 2 THEN 2048 ELSE 1 END AS block_y,
    CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 + p_size % 5 END AS overview_count,
    ROUND(p_retailprice * 100) / 64 AS size_mb,
    CASE p_partkey % 10 WHEN 9 THEN 'failed' WHEN 8 THEN 'skipped' ELSE 'copied' END AS status
    FROM part)
"""


def with_sql(*parts: str) -> str:
    """A WITH clause from fixture texts."""
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"
