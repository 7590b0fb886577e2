"""The clustered footprint store, and objects that change between listings."""

import glob
import json
import tempfile

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry
from terraloom.sources import footprints
from terraloom.streaming import changes

RNG = np.random.default_rng(8)


def boxes(spark, n, prefix="", extra=()):
    x, y = RNG.uniform(0, 10_000, (2, n))
    side = RNG.choice([1.0, 30.0, 400.0], n)
    rows = [(k, float(a), float(b), float(a + s), float(b + s)) for k, (a, b, s) in enumerate(zip(x, y, side))] + list(extra)
    return spark.createDataFrame(rows, f"{prefix}id long, {prefix}minx double, {prefix}miny double, {prefix}maxx double, {prefix}maxy double"), rows


@pytest.fixture(scope="module")
def store(spark):
    items, rows = boxes(spark, 4000, extra=[(9000, None, None, None, None), (9001, 5.0, 5.0, 5.0, 5.0)])
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/items"
    footprints.store(items.withColumn("geometry", geometry.box_wkb("minx", "miny", "maxx", "maxy")), root, file_items=300)
    return root, rows


def touching(rows, box):
    return {r[0] for r in rows if r[1] is not None and r[1] <= box[2] and r[3] >= box[0] and r[2] <= box[3] and r[4] >= box[1]}


def test_curve_keeps_neighbours_together(spark):
    df = spark.createDataFrame([(x, y) for x in range(16) for y in range(16)], "x int, y int")
    got = {(r.x, r.y): r.z for r in df.select("x", "y", footprints.curve(F.col("x"), F.col("y"), (0, 0, 16, 16)).alias("z")).collect()}
    want = {p: sum((p[0] >> b & 1) << 2 * b | (p[1] >> b & 1) << 2 * b + 1 for b in range(4)) for p in got}
    scale = got[1, 0] // want[1, 0]
    assert len(set(got.values())) == 256 and all(got[p] == want[p] * scale for p in got)


def test_store_is_clustered_geoparquet(store):
    root, rows = store
    files = sorted(glob.glob(f"{root}/part-*.parquet"))
    assert 8 <= len(files) <= 16
    seen, area = 0, 0.0
    for name in files:
        table = pq.read_table(name)
        geo = json.loads(pq.read_schema(name).metadata[b"geo"])
        assert geo["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
        curve = table["curve"].to_pylist()
        assert curve == sorted(curve)
        box = [b for b in table["bbox"].to_pylist() if b["xmin"] is not None]
        area += (max(b["xmin"] for b in box) - min(b["xmin"] for b in box)) * (max(b["ymin"] for b in box) - min(b["ymin"] for b in box))
        seen += table.num_rows
    assert seen == len(rows) and area < 3.5e8  # unordered files would each cover all of the 1e8 area


def test_window_is_pushed_to_the_scan(spark, store, plan_of):
    root, rows = store
    box = (2000.0, 3000.0, 2600.0, 3100.0)
    df = footprints.read(spark, root, box)
    plan = plan_of(df)
    assert "LessThanOrEqual(bbox.xmin,2600.0)" in plan and "GreaterThanOrEqual(bbox.ymax,3000.0)" in plan
    assert {r.id for r in df.collect()} == touching(rows, box)
    assert footprints.read(spark, root).count() == len(rows)


@pytest.mark.parametrize("small", [True, False])
def test_join_in_place(spark, store, plan_of, monkeypatch, small):
    root, rows = store
    areas, others = boxes(spark, 60, "b_")
    if not small:
        monkeypatch.setattr(footprints, "is_small", lambda df: False)
    df = footprints.join(spark, root, areas, 25.0)
    if small:
        # The items are scanned and joined where they are; only areas and totals travel.
        plan = plan_of(df.select("id", "b_id")).split("===== Subqueries")[0]
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    got = [(r.b_id, r.id) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == {(b[0], i) for b in others for i in touching(rows, b[1:])}
    assert set(df.columns) == {"id", "minx", "miny", "maxx", "maxy", "geometry", "b_id", "b_minx", "b_miny", "b_maxx", "b_maxy"}


def test_a_task_writes_a_run_of_small_files(spark):
    """Files of a few items do not take a task each; items that come twice, or have no box, are all kept."""
    items, rows = boxes(spark, 5000, extra=[(9000 + k, None, None, None, None) for k in range(40)] + [(7, 5.0, 5.0, 5.0, 5.0)] * 30)
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/items"
    for _ in range(2):  # the second time over the files of the first
        footprints.store(items.withColumn("geometry", geometry.box_wkb("minx", "miny", "maxx", "maxy")), root, file_items=8)
    files = sorted(glob.glob(f"{root}/*"))
    tables = [pq.read_table(name) for name in files]
    assert len({name.split("part-")[1][:5] for name in files}) < 100 and 600 < len(files) < 750
    assert max(t.num_rows for t in tables) == 8 and sorted(k for t in tables for k in t["id"].to_pylist()) == sorted(r[0] for r in rows)
    curve = [v for t in tables for v in t["curve"].to_pylist()]
    assert curve == sorted(curve) and all(b"geo" in pq.read_schema(name).metadata for name in files)
    box = (2000.0, 3000.0, 2600.0, 3100.0)
    assert {r.id for r in footprints.read(spark, root, box).collect()} == touching(rows, box)


@pytest.mark.parametrize("small", [True, False])
def test_join_returns_the_columns_named(spark, store, monkeypatch, small):
    root, rows = store
    areas, others = boxes(spark, 40, "b_")
    if not small:
        monkeypatch.setattr(footprints, "is_small", lambda df: False)
    df = footprints.join(spark, root, areas, 25.0, columns=["b_id", "id", "minx"])
    assert df.columns == ["b_id", "id", "minx"]
    assert sorted(map(tuple, df.collect())) == sorted((b[0], i, rows_by[i]) for rows_by in [{r[0]: r[1] for r in rows}] for b in others for i in touching(rows, b[1:]))
    assert footprints.join(spark, root, areas.limit(0), 25.0, columns=["b_id", "id"]).columns == ["b_id", "id"]


def test_empty_sides(spark, store):
    root, _ = store
    areas, _ = boxes(spark, 3, "b_")
    assert footprints.join(spark, root, areas.limit(0), 25.0).count() == 0
    items, _ = boxes(spark, 5)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/none"
    footprints.store(items.limit(0).withColumn("geometry", F.lit(b"")), folder)
    assert footprints.read(spark, folder).count() == 0


# Changed objects

def listing(spark, entries):
    return spark.createDataFrame([(p, n, t) for p, (n, t) in entries.items()], "path string, length long, t long").select(
        "path", "length", F.timestamp_seconds("t").alias("modificationTime"))


def test_objects_change(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    first = {"a": (1, 10), "b": (2, 10), "c": (3, 10)}
    second = {"a": (1, 10), "b": (5, 11), "d": (4, 11)}
    third = {"a": (1, 12), "b": (5, 11), "d": (4, 11), "c": (3, 10)}
    seen = []
    for run, entries in enumerate((first, second)):
        changes.record(listing(spark, entries), root, run)
        changes.advance(spark, root, seen.append)
    got = {(r.path, r.run): (r.status, r.old_length) for r in changes.changes(spark, root).collect()}
    assert got == {("a", 0): ("new", None), ("b", 0): ("new", None), ("c", 0): ("new", None),
                   ("a", 1): ("unchanged", 1), ("b", 1): ("changed", 2), ("d", 1): ("new", None)}
    assert {r.path for r in changes.gone(spark, root, listing(spark, second)).collect()} == {"c"}
    # Two snapshots in one batch, in the order of their runs.
    changes.record(listing(spark, third), root, 2)
    changes.record(listing(spark, first), root, 3)
    changes.advance(spark, root, seen.append)
    got = {(r.path, r.run): r.status for r in changes.changes(spark, root, "changed").collect()}
    assert got == {("b", 1): "changed", ("a", 2): "changed", ("b", 3): "changed", ("a", 3): "changed"}
    assert {r.path: (r.length, r.run) for r in changes.manifest(spark, root).collect()} == {"a": (1, 3), "b": (2, 3), "c": (3, 3), "d": (4, 2)}
    changes.advance(spark, root, seen.append)
    assert seen == [0, 1, 2]


@pytest.mark.parametrize("fails_at", [0, 1])
def test_a_failed_batch_runs_again(spark, fails_at):
    root, calls = tempfile.mkdtemp(prefix="run-", dir="/tmp"), []

    def then(batch):
        calls.append(batch)
        if batch == fails_at and calls.count(batch) == 1:
            raise RuntimeError("stopped")

    for run in range(2):
        changes.record(listing(spark, {"a": (run, run), "b": (1, 1)}), root, run)
        try:
            changes.advance(spark, root, then)
        except Exception:
            changes.advance(spark, root, then)
    assert calls.count(fails_at) == 2
    got = sorted((r.path, r.run, r.status) for r in changes.changes(spark, root).collect())
    assert got == [("a", 0, "new"), ("a", 1, "changed"), ("b", 0, "new"), ("b", 1, "unchanged")]
    assert {r.path: (r.length, r.run) for r in changes.manifest(spark, root).collect()} == {"a": (1, 1), "b": (1, 1)}
    assert changes.manifest(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp")).count() == 0


def test_batches_are_compared_without_python(spark, plan_of):
    seen = spark.createDataFrame([("a", 1, 10, 0), ("a", 1, 10, 1), ("b", 2, 10, 1)], "path string, length long, t long, run long").select(
        "path", "length", F.timestamp_seconds("t").alias("modified"), "run")
    old = seen.filter("path = 'a' AND run = 0").withColumns({"length": F.lit(None).cast("long"), "run": F.lit(-1).cast("long")})
    told = changes._told(seen, old)
    assert {(r.path, r.run): (r.status, r.old_length) for r in told.collect()} == {
        ("a", 0): ("changed", None), ("a", 1): ("unchanged", 1), ("b", 1): ("new", None)}
    plan = plan_of(told)
    assert "Pandas" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") <= 1
