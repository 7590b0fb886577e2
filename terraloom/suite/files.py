"""Listing, document, raster file and sink queries.

Files are written by Spark tasks from the driver's tables into the folder
the session shares, a new one for each call.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from terraloom.functions import files, href as hrefs
from terraloom.operators import catalog, inventory, joins, transfer
from terraloom.session import shared_folder
from terraloom.sources import documents as docs_source, listing, rasters, sinks
from terraloom.streaming import incremental
from terraloom.suite import catalog as cq, fixtures as fx, tiffs
from terraloom.suite.registry import query, six

c = F.col
K = fx.with_sql(fx.KEYS_SQL)
L = fx.with_sql(fx.LINKS_SQL)
S = fx.with_sql(fx.SCENE_SQL)


def folder(spark) -> str:
    """A new folder below the one all executors reach."""
    return f"{shared_folder(spark)}/suite-{uuid.uuid4().hex}"


def put(df, root: str) -> None:
    """Write ``(key, body)`` rows as files."""
    def write(batches):
        fs, inner = files.filesystem(root)
        for pdf in batches:
            for key, body in zip(pdf["key"], pdf["body"]):
                name = f"{inner}/{key}"
                fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(name) as sink:
                    sink.write(body)
            yield pd.DataFrame({"n": [len(pdf)]})

    # Rows of one key stay together; small rows would else end in few tasks.
    spread = df.select("key", "body").repartition(listing.tasks_of(df.sparkSession), "key")
    spread.mapInPandas(write, "n bigint").agg(F.sum("n")).first()


def relative(path, root):
    return files.below(path, root)


# ---- documents ------------------------------------------------------------

def catalogue_files(spark, sf):
    root = folder(spark)
    docs = cq.catalogue_docs(spark, sf)
    text = F.to_json(F.struct(F.concat(F.lit("d"), "part").alias("id"), "links"))
    body = F.when(c("part") % 5 == 3, F.substring(text, 1, 30)).otherwise(text)
    put(docs.select(F.concat(F.lit("d"), "part", F.lit(".json")).alias("key"), body.cast("binary").alias("body")), root)
    return docs_source.catalog(spark, root)


@query("s01_catalog_json", L + "SELECT rel, href, title FROM links WHERE (seq // 128) % 5 <> 3")
def catalog_json(spark, sf):
    good = docs_source.good(catalogue_files(spark, sf))
    return good.select(F.inline("links")).select("rel", "href", "title")


@query("s01_bad_json", L + "SELECT COUNT(DISTINCT seq // 128) AS bad FROM links WHERE (seq // 128) % 5 = 3")
def bad_json(spark, sf):
    return docs_source.bad(catalogue_files(spark, sf)).agg(F.count(F.lit(1)).alias("bad"))


@query("s02_read_documents", cq.D + """SELECT l.seq, docs.doc % 17 <> 5 AS found, docs.doc % 17 <> 5 AND docs.doc % 23 <> 7 AS readable
FROM links l JOIN docs USING (href)""")
def read_documents(spark, sf):
    root = folder(spark)
    put(cq.documents(spark, sf).select("key", c("text").cast("binary").alias("body")), root)
    docs = joins.stored(docs_source.texts(spark, root, root), "documents")  # the files are read once
    wanted = fx.links(spark, sf).select("seq", cq.catalog_key(c("href")).alias("key"))
    ok = catalog.parsed(docs, catalog.COLLECTION).select("key", F.lit(True).alias("ok"))
    found = catalog.existing_documents(wanted, docs).join(ok, "key", "left")
    return found.select("seq", c("text").isNotNull().alias("found"), F.coalesce("ok", F.lit(False)).alias("readable"))


# ---- listings -------------------------------------------------------------

def page_files(spark, sf):
    """Each page as a file; the body is its html."""
    root = folder(spark)
    pages = fx.table(spark, sf, "pages").select("page_id", c("html").cast("binary").alias("body"))
    own = F.when(c("key") == "catalog.json", F.concat(F.lit("c"), "page_id", F.lit("/"), "key")).otherwise(c("key"))
    keyed = fx.keys(spark, sf).select("page_id", own.alias("key")).join(pages, "page_id")
    put(keyed, root)
    return root


FILES = fx.with_sql(fx.KEYS_SQL + """, files AS (SELECT CASE WHEN key = 'catalog.json' THEN 'c' || page_id || '/catalog.json' ELSE key END AS key,
    CAST(octet_length(encode(html)) AS BIGINT) AS length FROM keys JOIN pages USING (page_id))""")


@query("s03_list_objects", FILES + "SELECT key, length FROM files WHERE key LIKE '%.tiff'")
def list_objects(spark, sf):
    root = page_files(spark, sf)
    found = listing.objects(spark, root, suffix=".tiff")
    return found.select(relative(c("path"), root).alias("key"), "length")


@query("s03_list_limit", FILES + "SELECT key FROM files WHERE key LIKE '%.jpg' ORDER BY key LIMIT 7")
def list_limit(spark, sf):
    root = page_files(spark, sf)
    return listing.objects(spark, root, suffix=".jpg", limit=7).select(relative(c("path"), root).alias("key"))


@query("s04_folder_prefix", K + "SELECT page_id, string_split(key, '/')[1] || '/' AS prefix FROM keys")
def folder_prefix(spark, sf):
    first = F.substring_index("key", "/", 1)
    mixed = F.when(c("page_id") % 2 == 0, first).otherwise(F.concat(first, F.lit("/")))
    return fx.keys(spark, sf).select("page_id", hrefs.as_folder(mixed).alias("prefix"))


@query("s05_root_json", K + "SELECT page_id, key FROM keys WHERE key NOT LIKE '%/%' AND lower(key) LIKE '%.json'")
def root_json(spark, sf):
    return listing.root_json(fx.keys(spark, sf)).select("page_id", "key")


def wanted_keys(spark, sf):
    return fx.keys(spark, sf).select("page_id", F.replace("key", F.lit(".TIF"), F.lit(".tiff")).alias("key"))


WANTED = K + ", wanted AS (SELECT page_id, REPLACE(key, '.TIF', '.tiff') AS key FROM keys)"


@query("s06_existing", WANTED + "SELECT page_id, key FROM wanted WHERE key IN (SELECT key FROM keys)")
def existing(spark, sf):
    return listing.existing(wanted_keys(spark, sf), fx.keys(spark, sf))


@query("j05_exists", WANTED + "SELECT w.key, COUNT(*) AS n FROM wanted w WHERE EXISTS (SELECT 1 FROM keys k WHERE k.key = w.key) GROUP BY w.key")
def exists(spark, sf):
    return listing.existing(wanted_keys(spark, sf), fx.keys(spark, sf)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("s09_pending", K + "SELECT page_id, key FROM keys WHERE key NOT IN (SELECT key FROM keys WHERE page_id % 4 = 0)")
def pending(spark, sf):
    keys = fx.keys(spark, sf)
    return listing.pending(keys, keys.filter(c("page_id") % 4 == 0)).select("page_id", "key")


@query("j04_not_existing", WANTED + "SELECT page_id, key FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM keys k WHERE k.key = w.key)")
def not_existing(spark, sf):
    return listing.pending(wanted_keys(spark, sf), fx.keys(spark, sf)).select("page_id", "key")


@query("s09_incremental_stream", FILES + "SELECT key, length FROM files WHERE lower(key) LIKE '%.tif' OR lower(key) LIKE '%.tiff'")
def incremental_stream(spark, sf):
    """Two runs over the same folder: the second adds nothing."""
    root, state = page_files(spark, sf), folder(spark)
    for _ in range(2):
        incremental.start(spark, root, f"{state}/manifest", f"{state}/checkpoint", (".tif", ".tiff")).awaitTermination()
    return spark.read.parquet(f"{state}/manifest").select(relative(c("path"), root).alias("key"), "length")


@query("s13_registry", """SELECT s_suppkey, n_name AS alias, CASE WHEN s_suppkey % 5 = 0 THEN 'own-' || s_suppkey ELSE 'bucket-' || n_nationkey END AS bucket,
    r_name AS region FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def registry(spark, sf):
    nation, region, supplier = (fx.table(spark, sf, t) for t in ("nation", "region", "supplier"))
    registry_df = nation.join(region, c("r_regionkey") == c("n_regionkey")).select(
        c("n_name").alias("alias"), F.concat(F.lit("bucket-"), "n_nationkey").alias("bucket"), c("r_name").alias("region"))
    requests = supplier.join(nation, c("n_nationkey") == c("s_nationkey")).select(
        "s_suppkey", c("n_name").alias("alias"),
        F.when(c("s_suppkey") % 5 == 0, F.concat(F.lit("own-"), "s_suppkey")).alias("bucket"),
        F.lit(None).cast("string").alias("region"))
    return listing.resolve(requests, registry_df)


@query("s14_raster_suffixes", K + "SELECT page_id, key FROM keys WHERE regexp_matches(lower(key), '\\.(tif|tiff|jpg|jpeg|png)$')")
def raster_suffixes(spark, sf):
    return fx.keys(spark, sf).filter(hrefs.has_suffix(c("key"), listing.IMAGE_SUFFIXES)).select("page_id", "key")


@query("p09_url_key", "SELECT page_id, ltrim(regexp_replace(regexp_replace(url, '^https?://[^/?#]*', ''), '[?#].*$', ''), '/') AS key FROM pages")
def url_key(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", hrefs.url_key(c("url")).alias("key"))


@query("p12_base_name", K + "SELECT page_id, string_split(key, '/')[-1] AS name FROM keys")
def base_name(spark, sf):
    return fx.keys(spark, sf).select("page_id", hrefs.base_name(c("key")).alias("name"))


ORDERED = fx.with_sql(fx.KEYS_SQL + ", distinct_keys AS (SELECT DISTINCT key FROM keys)")


def distinct_keys(spark, sf):
    return fx.keys(spark, sf).select("key").distinct()


@query("l02_first_keys", ORDERED + """SELECT key, (SELECT COUNT(*) FROM distinct_keys) AS total, (SELECT COUNT(*) - 20 FROM distinct_keys) AS remaining
FROM distinct_keys ORDER BY key LIMIT 20""")
def first_keys(spark, sf):
    return listing.first_with_rest(distinct_keys(spark, sf), 20, "key")


@query("l03_limit_before_filter", ORDERED + "SELECT key FROM (SELECT key FROM distinct_keys ORDER BY key LIMIT 30) WHERE lower(key) LIKE '%.tif' OR lower(key) LIKE '%.tiff'")
def limit_before(spark, sf):
    return listing.pick(distinct_keys(spark, sf), suffixes=(".tif", ".tiff"), limit=30, limit_scope="objects", col="key")


@query("l04_limit_after_filter", ORDERED + "SELECT key FROM distinct_keys WHERE lower(key) LIKE '%.tif' OR lower(key) LIKE '%.tiff' ORDER BY key LIMIT 30")
def limit_after(spark, sf):
    return listing.pick(distinct_keys(spark, sf), suffixes=(".tif", ".tiff"), limit=30, col="key")


@query("u02_union_by_suffix", ORDERED + "SELECT key FROM distinct_keys WHERE lower(key) LIKE '%.tif' UNION SELECT key FROM distinct_keys WHERE lower(key) LIKE '%.jpg'")
def union_by_suffix(spark, sf):
    keys = distinct_keys(spark, sf)
    parts = [keys.filter(hrefs.has_suffix(c("key"), [s])) for s in (".tif", ".jpg", ".TIF")]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


# ---- raster files ---------------------------------------------------------

def tile_files(spark, sf):
    """Each tile of the scene as one four-band TIFF file, in four layouts."""
    root = folder(spark)
    bands = fx.BANDS[:4]

    def encode(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                data, nodata = tiffs.whole(np.stack([np.asarray(getattr(r, b), dtype=float).reshape(fx.SIZE, fx.SIZE) for b in bands]), "uint8")
                kind = (r.tx + r.ty) % 4
                body = tiffs.encode(data, order="<>"[kind % 2], deflate=kind >= 2, tile=16 if kind in (1, 2) else 0,
                                    transform=(1000000.0 + r.tx * 8, 1.0, 5000000.0 - r.ty * 8, 1.0), epsg=2193,
                                    nodata=nodata, overview=kind == 3)
                out.append((f"{r.ty}/{r.tx}.tif", body))
            yield pd.DataFrame(out, columns=["key", "body"])

    put(fx.stored_tiles(spark, sf).mapInPandas(encode, "key string, body binary"), root)
    return root


def place(root):
    """tx and ty from the file name."""
    key = F.regexp_replace(relative(c("path"), root), ".tif$", "")
    return F.substring_index(key, "/", -1).cast("int"), F.substring_index(key, "/", 1).cast("int")


TILE_SET = S + ", t AS (SELECT DISTINCT x // 8 AS tx, y // 8 AS ty FROM scene)"


@query("s07_magic", TILE_SET + "SELECT tx, ty, CASE (tx + ty) % 2 WHEN 0 THEN '49492A0008000000' ELSE '4D4D002A00000008' END AS head, TRUE AS is_tiff FROM t")
def magic(spark, sf):
    root = tile_files(spark, sf)
    tx, ty = place(root)
    return listing.headers(spark, root, 8).select(tx.alias("tx"), ty.alias("ty"), "head", "is_tiff")


def tile_headers(spark, sf):
    root = tile_files(spark, sf)
    return rasters.headers(listing.objects(spark, root, suffixes=(".tif",))), place(root)


@query("s11_headers", TILE_SET + """SELECT tx, ty, CAST(8 AS INT) AS width, CAST(8 AS INT) AS height, CAST(4 AS INT) AS band_count, 'uint8' AS dtype,
    CASE WHEN (tx + ty) % 4 >= 2 THEN 'DEFLATE' ELSE 'NONE' END AS compression, CASE WHEN (tx + ty) % 4 IN (1, 2) THEN 'YES' ELSE 'NO' END AS tiled,
    CAST(CASE WHEN (tx + ty) % 4 IN (1, 2) THEN 16 ELSE 8 END AS INT) AS block_x, CAST(2193 AS INT) AS epsg,
    CAST(CASE WHEN (tx + ty) % 4 = 3 THEN 1 ELSE 0 END AS INT) AS overviews, 1000000.0::DOUBLE + tx * 8 AS x_min, 5000000.0::DOUBLE - ty * 8 - 8 AS y_min FROM t""")
def headers(spark, sf):
    found, (tx, ty) = tile_headers(spark, sf)
    return inventory.georeference(rasters.good(found)).select(
        tx.alias("tx"), ty.alias("ty"), "width", "height", "band_count", "dtype", "compression", "tiled", "block_x", "epsg",
        F.size("overview_widths").alias("overviews"), "x_min", "y_min")


@query("q05_describe", TILE_SET + """SELECT tx, ty, band, CASE band WHEN 1 THEN 'Red' WHEN 2 THEN 'Green' WHEN 3 THEN 'Blue' ELSE 'Undefined' END AS color_interp,
    (tx + ty) % 4 IN (1, 2) AND FALSE AS is_cog_b, ROUND(256 / 1048576.0::DOUBLE, 6) AS estimated_mb FROM t, (VALUES (1), (2), (3), (4)) b(band)""")
def describe(spark, sf):
    found, (tx, ty) = tile_headers(spark, sf)
    df = inventory.describe(found)
    return df.select(tx.alias("tx"), ty.alias("ty"), F.explode("bands").alias("b"), "is_cog_b", six("estimated_mb").alias("estimated_mb")).select(
        "tx", "ty", c("b.index").alias("band"), c("b.color_interp").alias("color_interp"), "is_cog_b", "estimated_mb")


@query("q06_batch_errors", FILES + "SELECT key, FALSE AS success FROM files WHERE lower(key) LIKE '%.tif' OR lower(key) LIKE '%.tiff'")
def batch_errors(spark, sf):
    """Pages named like rasters: every file fails and the batch goes on."""
    root = page_files(spark, sf)
    found = rasters.headers(listing.objects(spark, root, suffixes=(".tif", ".tiff")))
    return inventory.describe(found).select(relative(c("path"), root).alias("key"), "success")


@query("s12_ingest_tiles", S + "SELECT x, y, CAST(red AS FLOAT) AS red, CAST(green AS FLOAT) AS green, CAST(blue AS FLOAT) AS blue, CAST(nir AS FLOAT) AS nir FROM scene")
def ingest(spark, sf):
    found, (tx, ty) = tile_headers(spark, sf)
    px = rasters.to_pixels(rasters.blocks(found), fx.BANDS[:4])
    placed = px.withColumnRenamed("scene", "path").withColumns({"tx": tx, "ty": ty})
    return placed.select((c("tx") * 8 + c("x")).alias("x"), (c("ty") * 8 + c("y")).alias("y"), *fx.BANDS[:4])


# ---- sinks ----------------------------------------------------------------

COLLECTIONS = fx.with_sql(fx.COLLECTIONS_SQL)


def written_collections(spark, sf):
    root = folder(spark)
    sinks.collections(cq.collections(spark, sf), root)
    return root


@query("k01_write_collections", COLLECTIONS + f"SELECT {cq.COLUMNS} FROM collections WHERE rel = 'child'")
def write_collections(spark, sf):
    return spark.read.parquet(written_collections(spark, sf) + "/parquet")


@query("s08_parquet_by_type", COLLECTIONS + "SELECT type, href FROM collections WHERE rel = 'child' ORDER BY type")
def parquet_by_type(spark, sf):
    return docs_source.collections_parquet(spark, written_collections(spark, sf) + "/parquet").select("type", "href")


@query("s10_collections_csv", COLLECTIONS + f"SELECT {cq.COLUMNS} FROM collections WHERE rel = 'child'")
def collections_csv(spark, sf):
    return docs_source.collections_csv(spark, written_collections(spark, sf) + "/csv")


@query("k02_write_by_type", COLLECTIONS + "SELECT type, COUNT(*) AS n FROM collections WHERE rel = 'child' AND type <> '' GROUP BY type")
def write_by_type(spark, sf):
    root = folder(spark)
    sinks.by_type(cq.collections(spark, sf), root, "parquet")
    return spark.read.parquet(root).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def written_items(spark, sf):
    root = folder(spark)
    df = fx.items(spark, sf).withColumnsRenamed({n: f"bbox_{n}" for n in ("minx", "miny", "maxx", "maxy")})
    sinks.items(catalog.with_geometry(df), root)
    return root


@query("k03_write_items", fx.with_sql(fx.ITEMS_SQL) + "SELECT item_id, minx AS bbox_minx, 93 AS bytes FROM items WHERE minx IS NOT NULL")
def write_items(spark, sf):
    return spark.read.parquet(written_items(spark, sf) + "/geo").select(
        "item_id", "bbox_minx", F.octet_length("geometry").alias("bytes"))


@query("k03_write_items_csv", fx.with_sql(fx.ITEMS_SQL) + "SELECT item_id, CAST(maxx AS VARCHAR) AS bbox_maxx FROM items")
def write_items_csv(spark, sf):
    return spark.read.option("header", "true").csv(written_items(spark, sf) + "/csv").select("item_id", "bbox_maxx")


@query("k04_save_tiles", S + "SELECT 'dem' AS band, COUNT(*) AS cells, ROUND(SUM(dem), 3) AS total, 'EPSG:2193' AS crs FROM scene UNION ALL SELECT 'dsm', COUNT(*), ROUND(SUM(dsm), 3), 'EPSG:2193' FROM scene")
def save_tiles(spark, sf):
    from terraloom.operators import tiles

    root = folder(spark)
    long = tiles.by_band(fx.tiles(spark, sf).drop("red", "green", "blue", "nir"), ["dem", "dsm"])
    sinks.tiles(long, root, "EPSG:2193", (1000000, 1, 0, 5000000, 0, -1))
    back = spark.read.parquet(root).select("band", "crs", F.explode("data").alias("v"))
    return back.groupBy("band", "crs").agg(F.count(F.lit(1)).alias("cells"), F.round(F.sum("v"), 3).alias("total"))


@query("k06_copy_objects", FILES + """SELECT 'copied' AS status, COUNT(*) AS files, CAST(SUM(length) AS BIGINT) AS bytes FROM files WHERE regexp_matches(lower(key), '\\.(tif|tiff|jpg|jpeg|png)$')
UNION ALL SELECT 'skipped', COUNT(*), NULL FROM files WHERE regexp_matches(lower(key), '\\.(tif|tiff|jpg|jpeg|png)$')""")
def copy_objects(spark, sf):
    """The first run copies everything, the second finds everything present."""
    root, target, log = page_files(spark, sf), folder(spark), folder(spark)
    plan = transfer.plan(listing.objects(spark, root, suffixes=listing.IMAGE_SUFFIXES), target, root)
    for run in range(2):
        transfer.copy(plan).write.parquet(f"{log}/run={run}")
    return spark.read.parquet(log).groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
