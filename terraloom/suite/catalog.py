"""Catalogue, item and footprint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import geometry, href as hrefs
from terraloom.operators import catalog, ranking, spatial
from terraloom.plans import catalogue as plans
from terraloom.suite import fixtures as fx
from terraloom.suite.registry import query, six

c = F.col
L = fx.with_sql(fx.COLLECTIONS_SQL)
I = fx.with_sql(fx.ITEMS_SQL)
COLUMNS = "href, title, path, region, sub_region, type, crs, base_year, year_range, cellsize_cm, gsd, s3, https"


def catalogue_docs(spark, sf):
    """Catalogue documents of 128 links each."""
    return fx.links(spark, sf).groupBy(F.floor(c("seq") / 128).alias("part")).agg(
        F.collect_list(F.struct("rel", "href", "title")).alias("links"))


def collections(spark, sf):
    return plans.collections(catalogue_docs(spark, sf), fx.BUCKET, fx.REGION)


def documents(spark, sf):
    """One collection document per href; some are missing, some are no JSON."""
    docs = fx.links(spark, sf).groupBy("href").agg(F.min("seq").alias("doc"), F.min("title").alias("title"))
    links = fx.items(spark, sf).groupBy(c("collection_seq").alias("doc")).agg(
        F.collect_list(F.struct(F.lit("item").alias("rel"), c("item_href").alias("href"))).alias("items"))
    own = F.array(
        F.struct(F.lit("self").alias("rel"), c("href").alias("href")),
        F.struct(F.lit("item").alias("rel"), F.lit("").alias("href")),
    )
    text = F.to_json(F.struct(
        F.when(c("doc") % 41 == 0, "").otherwise(F.concat(F.lit("c"), c("doc").cast("string"))).alias("id"),
        F.concat(F.lit("Title "), "title").alias("title"), F.lit("Made for tests").alias("description"),
        F.when(c("doc") % 2 == 0, "CC-BY-4.0").alias("license"),
        F.concat(own, F.coalesce("items", F.slice(own, 1, 0))).alias("links"),
    ))
    return docs.join(links, "doc", "left").filter(c("doc") % 17 != 5).select(
        catalog_key(c("href")).alias("key"),
        F.when(c("doc") % 23 == 7, F.substring(text, 1, 20)).otherwise(text).alias("text"),
    )


def catalog_key(href):
    return F.regexp_replace(href, r"\./", "")


DOCS = """,
docs AS (SELECT href, MIN(seq) AS doc, MIN(title) AS doc_title FROM links GROUP BY href),
readable AS (SELECT * FROM docs WHERE doc % 17 <> 5 AND doc % 23 <> 7),
listed AS (SELECT collection_seq AS doc, COUNT(*) AS n FROM items GROUP BY collection_seq),
facts AS (SELECT href, doc, CASE WHEN doc % 41 = 0 THEN '' ELSE 'c' || CAST(doc AS VARCHAR) END AS collection_id,
    'Title ' || doc_title AS collection_title, 'Made for tests' AS collection_description,
    CASE WHEN doc % 2 = 0 THEN 'CC-BY-4.0' ELSE '' END AS license, CAST(2 + COALESCE(n, 0) AS INT) AS image_count
    FROM readable LEFT JOIN listed USING (doc))
"""
D = fx.with_sql(fx.COLLECTIONS_SQL, fx.ITEMS_SQL) + DOCS


# ---- paths ----------------------------------------------------------------

@query("w01_child_links", fx.with_sql(fx.LINKS_SQL) + "SELECT href, title FROM links WHERE rel = 'child'")
def child_links(spark, sf):
    return catalog.links(catalogue_docs(spark, sf), "child")


def parsed(spark, sf):
    return catalog.parse_href(fx.links(spark, sf), fx.BUCKET, fx.REGION)


def path_query(name, columns, where=""):
    """A projection of the parsed links."""
    @query(name, L + f"SELECT seq, {', '.join(columns)} FROM collections {where and 'WHERE ' + where}")
    def run(spark, sf):
        df = parsed(spark, sf)
        return (df.filter(where) if where else df).select("seq", *columns)


path_query("p02_path_split", ["path", "type", "crs"])
path_query("p03_region", ["region", "sub_region"])
path_query("p04_short_paths", ["path", "type", "crs", "base_year", "year_range", "cellsize_cm", "gsd"], "type = ''")
path_query("p05_years", ["year_range", "base_year"])
path_query("p06_gsd", ["gsd"])
path_query("p07_cellsize", ["cellsize_cm"])
path_query("p08_locations", ["s3", "https"])


@query("p01_clean_path", L + "SELECT seq, whole FROM href_clean")
def clean_path(spark, sf):
    return fx.links(spark, sf).select("seq", hrefs.clean_path(c("href")).alias("whole"))


@query("p11_collection_url", fx.with_sql(fx.LINKS_SQL) + f"""SELECT seq, CASE WHEN starts_with(href, './')
    THEN '{fx.BASE}/' || REPLACE(href, './', '') ELSE href END AS url FROM links""")
def collection_url(spark, sf):
    return fx.links(spark, sf).select("seq", hrefs.collection_url(c("href"), fx.BASE).alias("url"))


@query("p10_item_key", I + """SELECT item_id, CASE item_href[1] WHEN '.' THEN 'a/b_2019_1m/' || item_id || '.json'
    WHEN 'h' THEN 'a/b/' || item_id || '.json' ELSE 'a/b_2019_1m/' || item_href END AS key FROM items""")
def item_key(spark, sf):
    key = hrefs.item_key(c("item_href"), F.lit("a/b_2019_1m/collection.json"))
    return fx.items(spark, sf).select("item_id", key.alias("key"))


@query("p13_list_text", I + """SELECT item_id, CASE WHEN minx IS NULL THEN '[]' ELSE '[' || CAST(minx AS VARCHAR) || ', ' || CAST(miny AS VARCHAR) || ']' END AS corner FROM items""")
def list_text(spark, sf):
    corner = F.when(c("minx").isNotNull(), F.array("minx", "miny"))
    return fx.items(spark, sf).select("item_id", hrefs.list_text(corner).alias("corner"))


# ---- collections ----------------------------------------------------------

@query("x04_collections", L + f"SELECT {COLUMNS} FROM collections WHERE rel = 'child'")
def collections_table(spark, sf):
    return collections(spark, sf)


@query("a01_distribution", L + """SELECT name, value, COUNT(*) AS n FROM (
    SELECT 'type' AS name, type AS value FROM collections WHERE rel = 'child' UNION ALL
    SELECT 'crs', crs FROM collections WHERE rel = 'child' UNION ALL
    SELECT 'base_year', base_year FROM collections WHERE rel = 'child' UNION ALL
    SELECT 'region', region FROM collections WHERE rel = 'child') GROUP BY name, value""")
def distribution(spark, sf):
    return catalog.distribution(collections(spark, sf), ["type", "crs", "base_year", "region"]).orderBy(F.desc("n"))


@query("a02_distinct_types", L + "SELECT DISTINCT type FROM collections WHERE rel = 'child'")
def distinct_types(spark, sf):
    return collections(spark, sf).select("type").distinct()


@query("l01_sort_by_type", L + "SELECT seq, type, href FROM collections ORDER BY type")
def sort_by_type(spark, sf):
    return parsed(spark, sf).select("seq", "type", "href").orderBy("type", "href", "seq")


@query("v01_numbered", L + """SELECT seq, type, ROW_NUMBER() OVER (PARTITION BY type ORDER BY href, seq) AS i,
    COUNT(*) OVER (PARTITION BY type) AS n FROM collections""")
def numbered(spark, sf):
    df = parsed(spark, sf).select("seq", "type", "href")
    return ranking.row_numbers(df, "type", ["href", "seq"]).select("seq", "type", "i", "n")


@query("j01_enrich", D + f"""SELECT {COLUMNS}, collection_id, collection_title, collection_description, license, image_count
FROM collections JOIN facts USING (href) WHERE rel = 'child' AND collection_id <> ''""")
def enrich(spark, sf):
    return catalog.enrich(collections(spark, sf), documents(spark, sf))


@query("w02_with_metadata", D + """SELECT seq, collection_id FROM collections JOIN facts USING (href) WHERE collection_id <> ''""")
def with_metadata(spark, sf):
    return catalog.enrich(parsed(spark, sf), documents(spark, sf)).select("seq", "collection_id")


@query("a03_link_counts", D + """SELECT collection_id, image_count, CAST(image_count - 1 AS INT) AS item_count
FROM facts WHERE collection_id <> ''""")
def link_counts(spark, sf):
    hrefs_only = fx.links(spark, sf).select("href").distinct()
    docs = documents(spark, sf)
    every = catalog.enrich(hrefs_only, docs).select("collection_id", "image_count")
    only = catalog.enrich(hrefs_only, docs, only_items=True).select("collection_id", c("image_count").alias("item_count"))
    return every.join(only, "collection_id")


@query("x05_enriched_by_type", D + f"""SELECT type, COUNT(*) AS n, CAST(SUM(image_count) AS BIGINT) AS images
FROM collections JOIN facts USING (href) WHERE rel = 'child' AND collection_id <> '' AND type <> '' GROUP BY type""")
def enriched_by_type(spark, sf):
    df = plans.enriched(collections(spark, sf), documents(spark, sf))
    return df.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("image_count").alias("images"))


# ---- items ----------------------------------------------------------------

def item_documents(spark, sf):
    """One document per item, under the key its collection's folder gives it."""
    docs = fx.links(spark, sf).groupBy("href").agg(F.min("seq").alias("doc"))
    folder = F.regexp_replace(catalog_key(c("href")), "/collection.json$", "/")
    key = F.when(c("item_href").startswith("https"), F.concat(F.lit("a/b/"), "item_id", F.lit(".json"))).otherwise(
        F.concat(folder, "item_id", F.lit(".json")))
    date = F.date_format("acquired", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.to_json(F.struct(
        c("item_id").alias("id"), F.lit("Feature").alias("type"), F.lit("1.0.0").alias("stac_version"),
        F.when(c("minx").isNotNull(), F.array("minx", "miny", "maxx", "maxy")).alias("bbox"),
        F.struct(
            date.alias("datetime"), F.when(c("minx").isNotNull(), date).alias("start_datetime"),
            F.lit(0.25).alias("gsd"), F.lit(2193).alias("proj:epsg"),
            F.when(c("minx").isNotNull(), F.array(F.lit(0.25), F.lit(0.0), c("minx"))).alias("proj:transform"),
            F.array(F.lit(960), F.lit(1440)).alias("proj:shape"),
        ).alias("properties"),
        F.map_from_arrays(F.split("asset_types", ","), F.transform(
            F.split("asset_types", ","), lambda a: F.struct(F.concat(a, F.lit(".tif")).alias("href")))).alias("assets"),
    ))
    # Documents come as many files; the tables are one file each.
    return fx.items(spark, sf).join(docs, c("collection_seq") == c("doc")).filter(
        c("item_id").cast("bigint") % 29 != 3).repartition("item_id").select(key.alias("key"), text.alias("text"))


def items_table(spark, sf):
    return plans.items(collections(spark, sf), documents(spark, sf), item_documents(spark, sf), fx.BASE)


ITEM_TABLE = D + f""",
item_table AS (SELECT '{fx.BASE}/' || REPLACE(cc.href, './', '') AS collection_href, i.item_href, i.item_id, 'Feature' AS item_type, '1.0.0' AS stac_version,
    strftime(acquired, '%Y-%m-%dT%H:%M:%SZ') AS datetime,
    CASE WHEN minx IS NULL THEN '' ELSE strftime(acquired, '%Y-%m-%dT%H:%M:%SZ') END AS start_datetime, '' AS end_datetime,
    0.25::DOUBLE AS gsd, CAST(2193 AS INT) AS proj_epsg,
    CASE WHEN minx IS NULL THEN '[]' ELSE '[0.25, 0.0, ' || CAST(minx AS VARCHAR) || ']' END AS proj_transform, '[960, 1440]' AS proj_shape,
    minx AS bbox_minx, miny AS bbox_miny, maxx AS bbox_maxx, maxy AS bbox_maxy,
    CAST(CASE WHEN asset_types = 'visual' THEN 1 ELSE 4 END AS INT) AS asset_count, asset_types,
    f.collection_id, f.collection_title, cc.region, cc.sub_region, cc.type, cc.crs
    FROM collections cc JOIN facts f USING (href) JOIN items i ON i.collection_seq = f.doc
    WHERE rel = 'child' AND f.collection_id <> '' AND cc.type <> '' AND CAST(i.item_id AS BIGINT) % 29 <> 3)
"""


@query("x06_items", ITEM_TABLE + "SELECT * FROM item_table")
def items(spark, sf):
    return items_table(spark, sf)


@query("j02_item_context", ITEM_TABLE + "SELECT item_id, collection_id, collection_title, region, sub_region, type, crs FROM item_table")
def item_context(spark, sf):
    return items_table(spark, sf).select(
        "item_id", "collection_id", "collection_title", "region", "sub_region", "type", "crs")


@query("w03_valid_boxes", ITEM_TABLE + "SELECT item_id, bbox_minx, bbox_maxy FROM item_table WHERE bbox_minx IS NOT NULL")
def valid_boxes(spark, sf):
    return catalog.with_valid_box(items_table(spark, sf)).select("item_id", "bbox_minx", "bbox_maxy")


@query("w04_links_with_href", D + """SELECT f.collection_id, i.item_href FROM facts f JOIN items i ON i.collection_seq = f.doc
WHERE f.collection_id <> ''""")
def links_with_href(spark, sf):
    docs = documents(spark, sf)
    hrefs_only = fx.links(spark, sf).select("href").distinct().withColumns(
        {n: F.lit("") for n in ("region", "sub_region", "type", "crs")})
    return catalog.item_links(catalog.enrich(hrefs_only, docs), fx.BASE, docs).select("collection_id", "item_href")


@query("a04_assets", ITEM_TABLE + "SELECT item_id, asset_count, asset_types FROM item_table")
def assets(spark, sf):
    return items_table(spark, sf).select("item_id", "asset_count", "asset_types")


@query("a05_mean_assets", ITEM_TABLE + "SELECT region, COUNT(*) AS items, ROUND(AVG(asset_count), 6) AS mean_assets FROM item_table GROUP BY region")
def mean_assets(spark, sf):
    return items_table(spark, sf).groupBy("region").agg(
        F.count(F.lit(1)).alias("items"), six(F.avg("asset_count")).alias("mean_assets"))


@query("a06_extent", ITEM_TABLE + "SELECT MIN(bbox_minx) AS minx, MIN(bbox_miny) AS miny, MAX(bbox_maxx) AS maxx, MAX(bbox_maxy) AS maxy FROM item_table")
def extent(spark, sf):
    return catalog.extent(items_table(spark, sf))


@query("u01_append_items", ITEM_TABLE + """SELECT item_id, type, COUNT(*) AS n FROM (SELECT item_id, type FROM item_table UNION ALL
    SELECT item_id, NULL FROM items) GROUP BY item_id, type""")
def append_items(spark, sf):
    all_items = catalog.append([
        items_table(spark, sf).select("item_id", "type"), fx.items(spark, sf).select("item_id")])
    return all_items.groupBy("item_id", "type").agg(F.count(F.lit(1)).alias("n"))


# ---- geometry -------------------------------------------------------------

def boxed_documents(spark, sf):
    """Documents with the box nested, flat, at the top level, short, or absent."""
    k = c("seq")
    nums = [(k * 1.5).cast("string"), (k * 2.0).cast("string"), (k * 1.5 + 10).cast("string"), (k * 2.0 + 20).cast("string")]
    flat = F.concat(F.lit("["), F.concat_ws(",", *nums), F.lit("]"))
    text = F.when(k % 5 == 0, F.concat(F.lit('{"extent":{"spatial":{"bbox":['), flat, F.lit("]}}}"))).when(
        k % 5 == 1, F.concat(F.lit('{"extent":{"spatial":{"bbox":'), flat, F.lit("}}}"))).when(
        k % 5 == 2, F.concat(F.lit('{"extent":{"spatial":{"bbox":[]}},"bbox":'), flat, F.lit("}"))).when(
        k % 5 == 3, F.concat(F.lit('{"bbox":['), nums[0], F.lit("]}"))).otherwise(F.lit('{"id":"x"}'))
    return fx.links(spark, sf).select("seq", text.alias("text"))


@query("g01_collection_bbox", fx.with_sql(fx.LINKS_SQL) + """SELECT seq, CASE WHEN seq % 5 < 3 THEN seq * 1.5::DOUBLE END AS minx,
    CASE WHEN seq % 5 < 3 THEN seq * 2.0::DOUBLE END AS miny, CASE WHEN seq % 5 < 3 THEN seq * 1.5::DOUBLE + 10 END AS maxx,
    CASE WHEN seq % 5 < 3 THEN seq * 2.0::DOUBLE + 20 END AS maxy FROM links""")
def collection_bbox(spark, sf):
    box = geometry.box_of(geometry.collection_bbox(c("text")))
    return boxed_documents(spark, sf).select("seq", *[box[n].alias(n) for n in geometry.BOX])


@query("g02_item_polygon", I + """SELECT item_id, CASE WHEN minx IS NOT NULL THEN 'POLYGON ((' || maxx || ' ' || miny || ', ' || maxx || ' ' || maxy
    || ', ' || minx || ' ' || maxy || ', ' || minx || ' ' || miny || ', ' || maxx || ' ' || miny || '))' END AS wkt FROM items""")
def item_polygon(spark, sf):
    return fx.items(spark, sf).select("item_id", geometry.wkt(c("minx"), c("miny"), c("maxx"), c("maxy")).alias("wkt"))


# A whole number v >= 1 as eight little-endian bytes of a double: exponent and mantissa.
DOUBLE_SQL = """hexed AS (SELECT item_id, list_transform([maxx, miny, maxx, maxy, minx, maxy, minx, miny, maxx, miny], lambda v:
    printf('%016X', ((1023 + FLOOR(LOG2(v))::BIGINT) << 52) | ((v::BIGINT - (1::BIGINT << FLOOR(LOG2(v))::INT)) << (52 - FLOOR(LOG2(v))::INT)))) AS h FROM items)"""


@query("g02_item_wkb", fx.with_sql(fx.ITEMS_SQL, DOUBLE_SQL) + """SELECT item_id, CASE WHEN h[1] IS NOT NULL THEN '01030000000100000005000000' ||
    array_to_string(list_transform(h, lambda w: array_to_string(list_transform(range(7, -1, -1), lambda k: substr(w, (2 * k + 1)::INT, 2)), '')), '') END AS wkb FROM hexed""")
def item_wkb(spark, sf):
    return fx.items(spark, sf).select(
        "item_id", F.hex(geometry.box_wkb("minx", "miny", "maxx", "maxy")).alias("wkb"))


OVERLAP = "a.minx <= b.b_maxx AND b.b_minx <= a.maxx AND a.miny <= b.b_maxy AND b.b_miny <= a.maxy"


def boxes(spark, sf):
    return fx.items(spark, sf).select("item_id", *[c(n).alias(f"a_{n}") for n in ("minx", "miny", "maxx", "maxy")])


@query("j06_footprint_join", fx.with_sql(fx.ITEMS_SQL, fx.AREAS_SQL) + f"SELECT a.item_id, b.b_id FROM items a JOIN areas b ON {OVERLAP}")
def footprint_join(spark, sf):
    return spatial.bbox_join(boxes(spark, sf), fx.areas(spark, sf), 400.0, columns=["item_id", "b_id"]).select("item_id", "b_id")


@query("j06_items_per_area", fx.with_sql(fx.ITEMS_SQL, fx.AREAS_SQL) + f"""SELECT b.b_id, COUNT(*) AS items FROM items a JOIN areas b ON {OVERLAP}
GROUP BY b.b_id""")
def items_per_area(spark, sf):
    return spatial.bbox_counts(boxes(spark, sf), fx.areas(spark, sf), 400.0, "b_id").withColumnRenamed("n", "items")
