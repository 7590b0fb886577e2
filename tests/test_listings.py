"""Listings and documents that tasks read, and what of them reaches the driver."""

import os
import tempfile

from terraloom.functions import files
from terraloom.sources import listing
from terraloom.streaming import incremental


def folder(names, body=b"x"):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name in names:
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(names[name] if isinstance(names, dict) else body)
    return root


DEEP = [f"{a}/{b}/{c}/f.tif" for a in range(3) for b in range(3) for c in range(4)] + [
    "top.tif", "a b/c%20d.tif", "_hidden/f.tif", ".hidden.tif", "_x.tif", "_k=1/f.tif", "_metadata", "w._COPYING_"]


def by_spark(spark, root):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime", "length")


def test_tasks_list_what_spark_lists(spark, monkeypatch):
    root = folder(DEEP)
    os.makedirs(root + "/nothing/here")
    open(root + "/empty.tif", "w").close()
    want = sorted(map(tuple, by_spark(spark, root).collect()))
    for folders in (0, 2, 256):  # the fewer a task lists, the more rounds
        monkeypatch.setattr(listing, "FOLDERS", folders)
        for prefix in (root, root + "/", "file://" + root):
            assert sorted(map(tuple, listing.scan(spark, prefix).collect())) == want
    assert len(want) == 39 and sorted(map(tuple, listing.scan(spark, root + "/top.tif").collect())) == [w for w in want if w[0].endswith("/top.tif")]
    assert listing.scan(spark, root + "/*/1/0").count() == 3  # a pattern


def test_objects_are_not_the_input_of_a_plan(spark):
    root = folder(DEEP[:20])
    inside = lambda df: [f for f in df.inputFiles() if files.plain(f).startswith(root)]
    assert inside(by_spark(spark, root)) and not inside(listing.scan(spark, root))


def test_checkpoint_does_not_hold_the_objects(spark):
    root, state = folder(DEEP[:20]), folder([])
    for _ in range(2):
        incremental.start(spark, root, f"{state}/m", f"{state}/c", (".tif",)).awaitTermination()
    kept = "".join(open(f"{at}/{n}").read() for at, _, names in os.walk(f"{state}/c") for n in names if not n.endswith(".crc"))
    assert "f.tif" not in kept and f"{state}/c-listings" in kept
    assert sorted(r[0] for r in spark.read.parquet(f"{state}/m").select(files.below("path", root)).collect()) == sorted(DEEP[:20])


def test_a_listing_without_its_batch_comes_once(spark):
    """The stream ended after a listing was kept: the next start has both listings in one batch."""
    root, state = folder(DEEP[:5]), folder([])
    incremental.record(spark, root, f"{state}/m", f"{state}/c-listings", (".tif",))
    incremental.start(spark, root, f"{state}/m", f"{state}/c", (".tif",)).awaitTermination()
    assert spark.read.parquet(f"{state}/m").count() == 5
