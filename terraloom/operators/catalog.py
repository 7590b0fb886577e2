"""Catalogue operators: links, collections, items and their summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions import geometry, href as hrefs

# One parse per document: nested values that only travel as text are strings,
# and text that is no JSON object shows up in the last field.
BROKEN = "_broken"
LINKS = "array<struct<rel: string, href: string, title: string>>"
PROPERTIES = (
    "struct<datetime: string, start_datetime: string, end_datetime: string, gsd: double, "
    "`proj:epsg`: int, `proj:transform`: string, `proj:shape`: string>"
)
ITEM = (
    "struct<id: string, type: string, stac_version: string, bbox: array<double>, "
    f"properties: {PROPERTIES}, assets: map<string, string>, {BROKEN}: string>"
)
COLLECTION = (
    f"struct<id: string, title: string, description: string, license: string, links: {LINKS}, {BROKEN}: string>"
)
CONTEXT = ["collection_id", "collection_title", "region", "sub_region", "type", "crs"]


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def links(docs: DataFrame, rel: str, links_col: str = "links") -> DataFrame:
    """One row per link of the given relation: ``href, title``."""
    return docs.select(F.explode(links_col).alias("_link")).filter(F.col("_link.rel") == rel).select(
        or_empty(F.col("_link.href")).alias("href"), or_empty(F.col("_link.title")).alias("title")
    )


def parse_href(df: DataFrame, bucket: str | Column, region: str | Column, col: str = "href") -> DataFrame:
    """Add the path derived columns; see ``functions.href.stages``."""
    steps = hrefs.stages(F.col(col), bucket, region)
    for step in steps:
        df = df.withColumns(step)
    return df.drop(*[name for step in steps for name in step if name.startswith("_")])


def parsed(docs: DataFrame, schema: str) -> DataFrame:
    """``(key, doc)`` of the documents that are JSON objects.

    The explode of one element keeps the optimizer from copying the parser into
    the filter and every use: each document is parsed once.
    """
    doc = F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    return docs.select("key", F.explode(F.array(doc)).alias("doc")).filter(
        F.col("doc").isNotNull() & F.col(f"doc.{BROKEN}").isNull()
    )


def existing_documents(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` with the text of its document, null where it could not be read."""
    return wanted.join(docs.select("key", "text"), "key", "left")


def wanted_links(links_col: str) -> Column:
    """The item links of a document that have a href."""
    return F.filter(links_col, lambda l: (l["rel"] == "item") & (or_empty(l["href"]) != ""))


def enrich(collections: DataFrame, docs: DataFrame, only_items: bool = False,
           keep_links: bool = False) -> DataFrame:
    """Attach id, title, description, license and link count to collections.

    Joined on the cleaned href; documents are unique, so the join cannot fan out
    and adaptive skew handling may split an href that very many rows share.
    Collections without a readable document are
    dropped, as are those whose id is empty.  ``image_count`` counts all links;
    ``only_items`` counts item links.  ``keep_links`` adds the array
    ``item_links``, so that ``item_links`` need not read the documents again.
    """
    size = F.size(F.filter("doc.links", lambda l: l["rel"] == "item")) if only_items else F.size("doc.links")
    facts = parsed(docs, COLLECTION).select(
        "key",
        or_empty(F.col("doc.id")).alias("collection_id"),
        or_empty(F.col("doc.title")).alias("collection_title"),
        or_empty(F.col("doc.description")).alias("collection_description"),
        or_empty(F.col("doc.license")).alias("license"),
        F.when(F.col("doc.links").isNull(), 0).otherwise(size).alias("image_count"),
        *([wanted_links("doc.links").alias("item_links")] if keep_links else []),
    )
    key = F.replace(F.replace(F.col("href"), F.lit("./"), F.lit("")), F.lit("\\"), F.lit("/"))
    joined = collections.withColumn("key", key).join(facts, "key")
    return joined.filter(F.col("collection_id") != "").drop("key")


def item_links(collections: DataFrame, base: str, docs: DataFrame | None = None) -> DataFrame:
    """One row per item link of each collection, with the item's object key.

    Takes the links kept by ``enrich(keep_links=True)`` or reads them from
    ``docs``.  ``base`` is the url in front of relative collection hrefs.
    """
    url = hrefs.collection_url(F.col("href"), base)
    kept = ["item_links"] if docs is None else []
    wanted = collections.select(*CONTEXT, *kept, url.alias("collection_href"), hrefs.url_key(url).alias("key"))
    if docs is not None:
        listed = parsed(docs, COLLECTION).select("key", wanted_links("doc.links").alias("item_links"))
        wanted = wanted.join(listed, "key")
    # The links stay packed until after the join; what follows shuffles on the
    # item's own key, so a collection with very many items is spread again.
    return wanted.withColumn("_link", F.explode("item_links")).select(
        *CONTEXT, "collection_href", F.col("_link.href").alias("item_href"),
        hrefs.item_key(F.col("_link.href"), F.col("key")).alias("key"),
    )


def item_columns(doc: Column) -> dict[str, Column]:
    """The item table's columns from one item document."""
    props = doc["properties"]
    box = geometry.box_of(doc["bbox"])
    assets = F.map_keys(doc["assets"])

    def raw_list(name):
        return F.regexp_replace(F.coalesce(props[name], F.lit("[]")), r",\s*", ", ")

    return {
        "item_id": or_empty(doc["id"]),
        "item_type": or_empty(doc["type"]),
        "stac_version": or_empty(doc["stac_version"]),
        "datetime": or_empty(props["datetime"]),
        "start_datetime": or_empty(props["start_datetime"]),
        "end_datetime": or_empty(props["end_datetime"]),
        "gsd": props["gsd"],
        "proj_epsg": props["proj:epsg"],
        "proj_transform": raw_list("proj:transform"),
        "proj_shape": raw_list("proj:shape"),
        "bbox_minx": box["minx"],
        "bbox_miny": box["miny"],
        "bbox_maxx": box["maxx"],
        "bbox_maxy": box["maxy"],
        "asset_count": F.coalesce(F.size(assets), F.lit(0)),
        "asset_types": or_empty(F.array_join(assets, ",")),
    }


def items(collections: DataFrame, item_docs: DataFrame, base: str, docs: DataFrame | None = None) -> DataFrame:
    """The items table; unreadable items are left out, geometry is added by ``with_geometry``."""
    facts = parsed(item_docs, ITEM).select("key", *[
        value.alias(name) for name, value in item_columns(F.col("doc")).items()
    ])
    return item_links(collections, base, docs).join(facts, "key").drop("key")


def with_geometry(df: DataFrame) -> DataFrame:
    """Add ``geometry`` as well-known binary."""
    return df.withColumn(
        "geometry", geometry.box_wkb("bbox_minx", "bbox_miny", "bbox_maxx", "bbox_maxy")
    )


def with_valid_box(df: DataFrame) -> DataFrame:
    return df.filter(F.col("bbox_minx").isNotNull() & F.col("bbox_maxy").isNotNull())


def distribution(df: DataFrame, columns) -> DataFrame:
    """``name, value, n`` for several columns in one pass over the data."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value")) for name in columns
    ])
    return df.select(F.inline(pairs)).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def extent(items_df: DataFrame) -> DataFrame:
    return items_df.agg(
        F.min("bbox_minx").alias("minx"), F.min("bbox_miny").alias("miny"),
        F.max("bbox_maxx").alias("maxx"), F.max("bbox_maxy").alias("maxy"),
    )


def append(frames) -> DataFrame:
    """Rows of several item tables; a column missing in one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
