"""Cases that no registered query reaches: failing and sparse blocks, rewritten folders, repeated reads of a status, bounds on work."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import tilemath
from terraloom.operators import catalog, focal, halo, ranking, spatial, tiles, transfer
from terraloom.session import shared_folder
from terraloom.sources import listing, rasters, sinks
from terraloom.suite import tiffs


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_pointwise_keeps_rows_apart(spark):
    rows = [(1, [3.0, 1.0], [1.0, 1.0]), (2, [2.0, 2.0, 2.0], None), (3, None, None), (4, [5.0, 5.0, 5.0], [5.0]), (5, [], [])]
    df = spark.createDataFrame(rows, "id int, nir array<float>, red array<float>").coalesce(1)
    got = {r.id: r.v for r in df.select("id", tilemath.ndvi().alias("v")).collect()}
    assert got[1] == [0.5, 0.0] and np.isnan(got[2]).all() and len(got[2]) == 3
    assert got[3] is None and got[5] == [] and got[4][0] == 0.0 and np.isnan(got[4][1:]).all()
    sliced = {r.id: r.v for r in df.filter("id in (2, 4)").select("id", tilemath.ndvi().alias("v")).collect()}
    assert len(sliced[2]) == 3 and sliced[4][0] == 0.0


def test_pixels_of_a_tile_without_a_band(spark):
    df = spark.createDataFrame([("s", 0, 0, 2, 2, [1.0, float("nan"), 3.0, 4.0], None)], "scene string, tx int, ty int, w int, h int, a array<float>, b array<float>")
    got = {(r.x, r.y): (r.a, r.b) for r in tiles.to_pixels(df, ["a", "b"], 2).collect()}
    assert got == {(0, 0): (1.0, None), (1, 0): (None, None), (0, 1): (3.0, None), (1, 1): (4.0, None)}


def test_failing_and_sparse_blocks(spark):
    root = folder()
    data = np.arange(64, dtype=np.uint8).reshape(1, 8, 8)
    with open(f"{root}/a.tif", "wb") as file:
        file.write(tiffs.encode(data, order="<", deflate=False, tile=0))
    headers = rasters.headers(listing.objects(spark, root))
    sparse = headers.withColumns({"offsets": F.transform("offsets", lambda o: F.lit(0).cast("long")), "counts": F.transform("counts", lambda o: F.lit(0).cast("long"))})
    px = rasters.to_pixels(rasters.blocks(sparse), ["v"]).collect()
    assert len(px) == 64 and all(r.v is None for r in px)
    broken = headers.withColumn("compression", F.lit("DEFLATE"))
    blocks = rasters.blocks(broken)
    assert rasters.failed(blocks).count() == blocks.count() > 0
    assert rasters.to_pixels(blocks, ["v"], skip_failed=True).count() == 0
    with pytest.raises(Exception, match="block .* of "):
        rasters.to_pixels(blocks, ["v"]).collect()


def test_a_second_smaller_write_replaces_the_first(spark):
    root = folder()
    df = spark.range(100).withColumn("geometry", F.lit(b"g"))
    sinks.geoparquet(df.repartition(4), root)
    sinks.geoparquet(df.limit(10).coalesce(1), root)
    assert spark.read.parquet(root).count() == 10 and len(os.listdir(root)) == 1


def test_copy_status_is_read_twice_with_equal_answers(spark):
    root, target = folder(), folder()
    with open(f"{root}/x.tif", "w") as file:
        file.write("abc")
    status = transfer.copy(transfer.plan(listing.objects(spark, root), target, root))
    assert [r.status for r in status.collect()] == ["copied"] == [r.status for r in status.collect()]


def test_numbers_of_a_null_group_and_pieces_by_size(spark, monkeypatch):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 1)], "g string, k int")
    got = sorted(((r.g, r.k, r.i, r.n) for r in ranking.row_numbers(df, "g", ["k"]).collect()), key=str)
    assert got == sorted([(None, 1, 1, 2), (None, 3, 2, 2), ("a", 1, 1, 2), ("a", 2, 2, 2)], key=str)
    monkeypatch.setattr(ranking, "PIECE_ROWS", 500)
    big = spark.range(8000).withColumn("g", F.lit("a"))
    before = set(os.listdir(shared_folder(spark)))
    assert ranking.row_numbers(big, "g", ["id"]).filter("i <> id + 1").count() == 0
    new = [d for d in os.listdir(shared_folder(spark)) if d not in before]
    assert spark.read.parquet(f"{shared_folder(spark)}/{new[0]}").select("_piece").distinct().count() > 8


def test_few_candidates_with_one_large_box_on_each_side(spark):
    def side(p, n, shift):
        out = [(i, i * 10.0, shift, i * 10.0 + 1, shift + 1) for i in range(n)]
        return spark.createDataFrame([*out, (n, 0.0, 0.0, 1e5, 1e5)], f"{p}id int, " + ", ".join(f"{p}{k} double" for k in ("minx", "miny", "maxx", "maxy")))

    a, b = side("a_", 2000, 0.0), side("b_", 2000, 5.0)
    one = spatial._cells(a, "a_", 10.0).join(spatial._cells(b, "b_", 10.0, spatial._levels(a, "a_", 10.0)), ["_level", "_cx", "_cy"]).count()
    two = spatial._cells(a, "a_", 10.0, spatial._levels(b, "b_", 10.0), 1).join(spatial._cells(b, "b_", 10.0), ["_level", "_cx", "_cy"]).count()
    assert one + two < 20_000
    assert spatial.bbox_join(a, b, 10.0).count() == 4001


def test_class_codes_are_never_mixed_up(spark):
    px = spark.createDataFrame([("s", x, y, 65 if (x, y) != (3, 3) else 0) for x in range(7) for y in range(7)], "scene string, x int, y int, class int")
    got = {r.cleaned for r in focal.clean_classes(px, iterations=1, codes=[4, 65]).collect()}
    assert got == {65}
    with pytest.raises(Exception, match="class not among the codes"):
        focal.clean_classes(px).collect()
    many = px.withColumn("class", F.when(F.col("class") > 0, F.lit(100)).otherwise(0))
    assert {r.cleaned for r in focal.clean_classes(many, iterations=1, codes=range(1, 140)).collect()} == {100}


def test_documents_are_parsed_once(spark, plan_of):
    docs = spark.createDataFrame([("k", '{"id": "a"}'), ("b", "{")], "key string, text string")
    df = catalog.parsed(docs, catalog.COLLECTION).select("key", "doc.id", "doc.title")
    assert plan_of(df).count("from_json") <= 2 and df.count() == 1  # once in the node and once in its listing


def test_shared_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_tile_window_reaches_the_scan(spark, plan_of):
    root = folder()
    spark.createDataFrame([("s", t % 4, t // 4, 2, 2, [float(t)] * 4) for t in range(16)], "scene string, tx int, ty int, w int, h int, v array<float>").write.parquet(root + "/t")
    df = spatial.clip_tiles(spark.read.parquet(root + "/t"), ["v"], 2, (3.0, 2.0, 6.0, 5.0))
    assert "GreaterThanOrEqual(tx,1)" in plan_of(df) and "LessThanOrEqual(ty,2)" in plan_of(df)
    assert sorted((r.x, r.y) for r in df.collect()) == [(x, y) for x in (3, 4, 5) for y in (2, 3, 4)]


def test_format_summary_reads_its_source_once(spark, plan_of):
    from terraloom.operators import inventory

    root = folder()
    spark.createDataFrame([("GTiff", "LZW", "YES", True, True, 1.0)], "driver string, compression string, tiled string, is_cog_b boolean, has_overviews boolean, size_mb double").write.parquet(root + "/h")
    df = inventory.report(spark.read.parquet(root + "/h"))
    assert plan_of(df).count("Scan parquet") == 2 and df.count() == 3  # in the tree and in its listing
