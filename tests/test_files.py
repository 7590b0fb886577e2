"""Listings, documents, copies, streams and sinks on real files."""

import json
import os
import struct
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry
from terraloom.operators import catalog, transfer
from terraloom.plans import catalogue
from terraloom.sources import documents, listing, sinks
from terraloom.streaming import incremental


def folder(files=()):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, body in dict(files).items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(body if isinstance(body, bytes) else body.encode())
    return root


def names(df, col="path"):
    return sorted(os.path.basename(r[0]) for r in df.select(col).collect())


FILES = {"a/1.tif": "x", "a/2.TIFF": "xx", "a/3.jpg": "xxx", "b/4.txt": "x", "b/c/5.tiff": "x", "6.json": "{}"}


def test_listing_rules(spark):
    root = folder(FILES)
    assert names(listing.objects(spark, root)) == ["1.tif", "2.TIFF", "3.jpg", "4.txt", "5.tiff", "6.json"]
    assert names(listing.objects(spark, root, suffix=".tiff")) == ["5.tiff"]
    assert names(listing.objects(spark, root, suffixes=(".tif", ".tiff"))) == ["1.tif", "2.TIFF", "5.tiff"]
    assert names(listing.objects(spark, root, suffixes=(".tif", ".tiff"), limit=2)) == ["1.tif", "2.TIFF"]
    assert len(names(listing.objects(spark, root, suffixes=(".txt",), limit=2, limit_scope="objects"))) == 0
    assert names(listing.objects(spark, folder())) == []
    with pytest.raises(ValueError):
        listing.objects(spark, root, limit_scope="none")


def test_unknown_alias(spark):
    registry = spark.createDataFrame([("imagery", "b1", "r1")], "alias string, bucket string, region string")
    asked = spark.createDataFrame([("imagery", None, "other")], "alias string, bucket string, region string")
    assert [r.asDict() for r in listing.resolve(asked, registry).collect()] == [{"alias": "imagery", "bucket": "b1", "region": "other"}]
    with pytest.raises(ValueError, match="unknown alias: nowhere"):
        listing.resolve(asked.withColumn("alias", F.lit("nowhere")), registry)


def test_missing_catalogue_raises(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        documents.catalog(spark, "/tmp/does-not-exist.json")


def test_good_and_bad_catalogues(spark):
    root = folder({"a.json": json.dumps({"id": "a", "links": [{"rel": "child", "href": "./a/b_2019_1m/rgb/2193/collection.json"}, {"rel": "self"}]}),
                   "b.json": '{"id": '})
    docs = documents.catalog(spark, root)
    assert catalog.links(documents.good(docs), "child").collect()[0]["title"] == ""
    assert documents.bad(docs).count() == 1


def test_items_edge_cases(spark):
    base = "https://h"
    collection = {"id": "c1", "title": "T", "links": [{"rel": "item", "href": h} for h in ("./1.json", "2.json", "", "3.json", "4.json", "5.json")]}
    docs = spark.createDataFrame([("a/b_2019_1m/rgb/2193/collection.json", json.dumps(collection)), ("x/y_2019_1m/rgb/2193/collection.json", "not json")], "key string, text string")
    folder_key = "a/b_2019_1m/rgb/2193/"
    items = spark.createDataFrame([
        (folder_key + "1.json", json.dumps({"id": "i1", "type": "Feature", "bbox": [1, 2, 3, 4], "properties": {"gsd": 0.5, "proj:transform": [0.5, 0, 1800000.0], "datetime": None}, "assets": {"visual": {"href": "v"}, "nir": {}}})),
        (folder_key + "2.json", json.dumps({"id": "i2", "bbox": [1, 2, 3]})),
        (folder_key + "3.json", '{"id": "broken"'),
        (folder_key + "4.json", "[1, 2]"),
    ], "key string, text string")
    links = spark.createDataFrame([([{"rel": "child", "href": f"./{p}/collection.json", "title": "t"} for p in ("a/b_2019_1m/rgb/2193", "x/y_2019_1m/rgb/2193", "q/short")],)],
                                  "links array<struct<rel: string, href: string, title: string>>")
    collections = catalogue.collections(links, "b", "r")
    assert collections.count() == 3
    enriched = catalogue.enriched(collections, docs)
    row = enriched.collect()[0]
    assert enriched.count() == 1 and (row["collection_id"], row["license"], row["image_count"]) == ("c1", "", 6)
    got = {r["item_id"]: r for r in catalogue.items(collections, docs, items, base).collect()}
    assert set(got) == {"i1", "i2"}
    one, two = got["i1"], got["i2"]
    assert (one["asset_count"], one["asset_types"], one["proj_shape"], one["datetime"]) == (2, "visual,nir", "[]", "")
    assert one["proj_transform"] == "[0.5, 0, 1800000.0]" and one["bbox_maxy"] == 4.0 and one["region"] == "a"
    assert (two["asset_count"], two["asset_types"], two["bbox_minx"], two["gsd"]) == (0, "", None, None)


def test_wkb(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (None, 2.0, 3.0, 4.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geometry.box_wkb("a", "b", "c", "d")).collect()]
    ring = [(3.0, 2.0), (3.0, 4.0), (1.0, 4.0), (1.0, 2.0), (3.0, 2.0)]
    assert bytes(got[0]) == struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring)
    assert got[1] is None


def test_copy_skips_fails_and_flattens(spark):
    root, target = folder(FILES), folder({"1.tif": "old"})
    plan = transfer.plan(listing.objects(spark, root, suffixes=listing.IMAGE_SUFFIXES), target, root, flatten=True)
    missing = spark.createDataFrame([("/tmp/not-there.tif", 1, target + "/n.tif", True)], plan.schema)
    status = {os.path.basename(r["path"]): r for r in transfer.copy(plan.unionByName(missing)).collect()}
    assert {k: v["status"] for k, v in status.items()} == {
        "1.tif": "skipped", "2.TIFF": "copied", "3.jpg": "copied", "5.tiff": "copied", "not-there.tif": "failed"}
    assert status["2.TIFF"]["bytes"] == 2 and "not-there" in status["not-there.tif"]["error"]
    assert sorted(os.listdir(target)) == ["1.tif", "2.TIFF", "3.jpg", "5.tiff"]


def test_flattened_duplicates_are_copied_once(spark):
    root, target = folder({"a/1.tif": "first", "b/1.tif": "second"}), folder()
    plan = transfer.plan(listing.objects(spark, root), target, root, flatten=True)
    assert sorted(r["status"] for r in transfer.copy(plan).collect()) == ["copied", "skipped"]
    assert open(target + "/1.tif").read() == "first"


def test_stream_sees_each_object_once(spark):
    root, state = folder(FILES), folder()
    def run():
        incremental.start(spark, root, state + "/m", state + "/c", (".tif", ".tiff")).awaitTermination()
        return names(spark.read.parquet(state + "/m"))
    assert run() == ["1.tif", "2.TIFF", "5.tiff"]
    with open(root + "/a/7.tif", "w") as f:
        f.write("new")
    assert run() == ["1.tif", "2.TIFF", "5.tiff", "7.tif"]


def test_csv_round_trip_keeps_odd_text(spark):
    odd = 'say "hi", twice\nand \\ more'
    df = spark.createDataFrame([tuple([odd] + ["2193"] + [""] * 11)], ", ".join(f"{n} string" for n in documents.COLLECTION_COLUMNS))
    root = folder()
    sinks.collections(df, root)
    assert [tuple(r) for r in documents.collections_csv(spark, root + "/csv").collect()] == [tuple(r) for r in df.collect()]


def test_by_type_skips_empty(spark):
    root = folder()
    sinks.by_type(spark.createDataFrame([("a", "1"), ("", "2"), ("b", "3")], "type string, v string"), root)
    assert sorted(n for n in os.listdir(root) if n.startswith("type")) == ["type=a", "type=b"]


def test_geoparquet_footer(spark):
    root = folder()
    df = spark.createDataFrame([("i", 1.0, 2.0, 3.0, 4.0), ("n", None, None, None, None)],
                               "item_id string, bbox_minx double, bbox_miny double, bbox_maxx double, bbox_maxy double")
    sinks.items(catalog.with_geometry(df), root)
    parts = [p for p in os.listdir(root + "/geo") if p.endswith(".parquet")]
    geo = json.loads(pq.read_schema(f"{root}/geo/{parts[0]}").metadata[b"geo"])
    assert geo["primary_column"] == "geometry" and geo["columns"]["geometry"]["encoding"] == "WKB"
    assert [r["item_id"] for r in spark.read.parquet(root + "/geo").collect()] == ["i"]
    assert spark.read.option("header", "true").csv(root + "/csv").count() == 2


def test_append_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1)], "item_id string, n int")
    b = spark.createDataFrame([("y",)], "item_id string")
    assert sorted(map(tuple, catalog.append([a, b]).collect())) == [("x", 1), ("y", None)]
