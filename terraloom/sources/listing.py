"""Object listings and what can be asked of them."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import files, href as hrefs
from terraloom.operators.joins import lookup
from terraloom.session import shared_folder

# Extensions that count as raster files.
IMAGE_SUFFIXES = (".tif", ".tiff", ".jpg", ".jpeg", ".png")
RASTER_SUFFIXES = (
    ".tif", ".tiff", ".jpg", ".jpeg", ".png", ".jp2", ".webp",
    ".bmp", ".gif", ".hdf", ".nc", ".img", ".bil", ".bsq",
)
# The two TIFF byte-order marks, as hex.
TIFF_MAGIC = ("49492A00", "4D4D002A")


# Folders below its own that a task lists for a folder before the rest is dealt out again, folders of a task, rows of a batch.
FOLDERS, TASK_FOLDERS, BATCH_ROWS = 256, 20_000, 10_000
# An object, or a folder still to be listed, as the tasks write them.
ENTRY = "path string, modificationTime timestamp, length bigint, folder boolean"
ENTRY_ARROW = pa.schema([
    ("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("folder", pa.bool_())])


def scan(spark: SparkSession, prefix: str) -> DataFrame:
    """Every object under a prefix: ``path, modificationTime, length`` (no content read).

    Folders are listed by tasks and the listing stays below the shared folder, so
    the driver sees none of it.  Hidden names and empty objects are left out as Spark does.
    Patterns, and stores that only Spark's readers open, are listed by Spark, which
    also tells of a missing path.
    """
    head = files.head(prefix)
    if head is None or not files.exists(prefix):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
    else:
        found = _walk(spark, prefix, head)
    return found.select("path", "modificationTime", "length")


def tasks_of(spark: SparkSession) -> int:
    """Explicit task count: rows here are tiny but stand for much reading, so adaptive coalescing by size must not merge them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _walk(spark: SparkSession, prefix: str, head: str) -> DataFrame:
    """Round by round, each folder is listed by one task; what is too much for it is dealt out in the next round."""
    def entries(fs, top):
        """The objects under a folder, and the folders left over."""
        todo, listed = [top], 0
        while todo and listed <= FOLDERS:
            at, listed = todo.pop(), listed + 1
            info = fs.get_file_info(at)
            inside = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
            for e in inside:
                if e is not info and _hidden(e.base_name):
                    continue
                if e.type == pafs.FileType.Directory:
                    todo.append(e.path)
                elif e.type != pafs.FileType.NotFound:
                    yield head + e.path, (e.mtime_ns or 0) // 1_000_000 * 1000, e.size, False
        for at in todo:
            yield at, None, None, True

    def read(batches):
        fs, rows = files.filesystem(prefix)[0], []
        for batch in batches:
            for top in batch.column("path").to_pylist():
                for row in entries(fs, top):
                    rows.append(row)
                    if len(rows) >= BATCH_ROWS:
                        yield _entries(rows)
                        rows = []
        if rows:
            yield _entries(rows)

    folder = f"{shared_folder(spark)}/listing-{uuid.uuid4().hex}"
    todo, left, number = spark.createDataFrame([(files.filesystem(prefix)[1],)], "path string"), 1, 0
    while left:
        tasks = max(min(left, tasks_of(spark)), -(-left // TASK_FOLDERS))
        at = f"{folder}/{number}"
        todo.repartition(tasks).mapInArrow(read, ENTRY).write.parquet(at)
        todo, number = spark.read.schema(ENTRY).parquet(at).filter("folder").select("path"), number + 1
        left = todo.count()
    return spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(folder).filter("NOT folder AND length > 0")


def _entries(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), ENTRY_ARROW)], schema=ENTRY_ARROW)


def pick(listing: DataFrame, suffix: str = "", suffixes=(), limit: int = 0,
         limit_scope: str = "matches", col: str = "path") -> DataFrame:
    """Filter a listing and cut it to its first ``limit`` rows by key.

    ``suffix`` is case-sensitive, ``suffixes`` is not.  ``limit_scope="objects"``
    applies the limit before ``suffixes``, so fewer rows may come back.
    """
    if limit_scope not in ("matches", "objects"):
        raise ValueError(f"limit_scope must be 'matches' or 'objects', not {limit_scope!r}")
    if suffix:
        listing = listing.filter(F.col(col).endswith(suffix))
    keep = hrefs.has_suffix(F.col(col), suffixes) if suffixes else F.lit(True)
    if limit and limit_scope == "objects":
        return listing.orderBy(col).limit(limit).filter(keep)
    listing = listing.filter(keep)
    return listing.orderBy(col).limit(limit) if limit else listing


def objects(spark: SparkSession, prefix: str, suffix: str = "", suffixes=(), limit: int = 0,
            limit_scope: str = "matches") -> DataFrame:
    """List, filter and limit in one call; an empty folder gives no rows."""
    return pick(scan(spark, prefix), suffix, suffixes, limit, limit_scope)


def root_json(listing: DataFrame, col: str = "key") -> DataFrame:
    """JSON files at the root: candidates for a catalogue document."""
    return listing.filter(~F.col(col).contains("/") & F.lower(col).endswith(".json"))


def existing(wanted: DataFrame, listing: DataFrame, on: str = "key") -> DataFrame:
    return wanted.join(listing.select(on).distinct(), on, "left_semi")


def pending(wanted: DataFrame, manifest: DataFrame, on: str = "key") -> DataFrame:
    """What is not in the manifest yet."""
    return wanted.join(manifest.select(on).distinct(), on, "left_anti")


def headers(spark: SparkSession, prefix: str, length: int = 16) -> DataFrame:
    """First bytes of each file as hex, with the TIFF test; only these bytes are read.

    A file that cannot be opened has a null ``head``.
    """

    def read(batches):
        for pdf in batches:
            head = []
            for path in pdf.path:
                try:
                    with files.open_file(path) as file:
                        head.append(file.read(length).hex().upper())
                except OSError:
                    head.append(None)
            yield pdf.assign(head=head)

    found = scan(spark, prefix).select("path", "length").mapInPandas(read, "path string, length long, head string")
    return found.withColumn(
        "is_tiff", F.substring("head", 1, 8).isin(*TIFF_MAGIC)
    )


def resolve(requests: DataFrame, registry: DataFrame, strict: bool = True) -> DataFrame:
    """Fill ``bucket`` and ``region`` of requests from a registry by ``alias``.

    Requests may carry their own ``bucket`` or ``region``, which win.  With
    ``strict`` an unknown alias raises ``ValueError`` (runs a small job).
    """
    if strict:
        unknown = requests.join(registry, "alias", "left_anti").select("alias").distinct().limit(5).collect()
        if unknown:
            raise ValueError("unknown alias: " + ", ".join(sorted(str(r[0]) for r in unknown)))
    defaults = registry.select(
        "alias", F.col("bucket").alias("_bucket"), F.col("region").alias("_region")
    )
    return lookup(requests, defaults, ["alias"], "inner").withColumns({
        "bucket": F.coalesce("bucket", "_bucket"), "region": F.coalesce("region", "_region"),
    }).drop("_bucket", "_region")


def first_with_rest(listing: DataFrame, n: int, col: str = "path") -> DataFrame:
    """The first ``n`` keys, each with the total and the number not shown."""
    total = listing.agg(F.count(F.lit(1)).alias("total"))
    return listing.select(col).orderBy(col).limit(n).withColumn("total", total.scalar()).withColumn(
        "remaining", F.greatest(F.col("total") - n, F.lit(0))
    )
