"""JSON documents, catalogue tables and their writers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from terraloom.functions import files
from terraloom.sources import listing

# Files and bytes that a task reads on average, and that are handed on at once.
TASK_FILES, TASK_BYTES = 20_000, 256 * 1024 * 1024
BATCH_FILES, BATCH_BYTES = 1_000, 16 * 1024 * 1024

LINK = StructType([StructField(n, StringType()) for n in ("rel", "href", "title")])
CATALOG = StructType([
    StructField("id", StringType()),
    StructField("links", ArrayType(LINK)),
    StructField("_corrupt_record", StringType()),
])

COLLECTION_COLUMNS = [
    "href", "title", "path", "region", "sub_region", "type", "crs",
    "base_year", "year_range", "cellsize_cm", "gsd", "s3", "https",
]


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue documents.  A missing path raises; see ``good`` and ``bad``."""
    return spark.read.schema(CATALOG).json(path, multiLine=True)


def good(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def bad(docs: DataFrame) -> DataFrame:
    """The documents that are not JSON, as text.

    The test names a data column too: Spark refuses to read the corrupt column
    alone from files.
    """
    parsed = F.coalesce(F.size("links"), F.lit(0)) >= 0
    return docs.filter(F.col("_corrupt_record").isNotNull() & parsed).select("_corrupt_record")


def texts(spark: SparkSession, path, root: str = "") -> DataFrame:
    """Many documents as ``(key, text)``; ``root`` is cut off the file path, empty files have no row.

    Small files are opened by tasks straight from the listing; several paths,
    patterns and stores that only Spark's readers open are read by Spark.
    """
    if files.head(path) is None:
        read = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        return read.select(files.below("_metadata.file_path", root).alias("key"), F.col("value").alias("text"))
    listed = listing.scan(spark, path).select("path", "length")
    total = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).first()
    tasks = max(1, min(total["n"], listing.tasks_of(spark)), -(-total["n"] // TASK_FILES), -(-(total["bytes"] or 0) // TASK_BYTES))

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for name in batch.column("path").to_pylist():
                fs, inner = files.filesystem(name)
                with fs.open_input_stream(inner, compression="detect") as file:
                    rows.append((name, file.read()))
                held += len(rows[-1][1])
                # Documents differ in size: hand them on by bytes as well as by count.
                if held >= BATCH_BYTES or len(rows) >= BATCH_FILES:
                    yield _bodies(rows)
                    rows, held = [], 0
        if rows:
            yield _bodies(rows)

    found = listed.select("path").repartition(tasks, "path").mapInArrow(read, "path string, body binary")
    return found.select(files.below("path", root).alias("key"), F.col("body").cast("string").alias("text"))


def _bodies(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (pa.string(), pa.binary()))], ["path", "body"])


def collections_csv(spark: SparkSession, path: str, columns=COLLECTION_COLUMNS) -> DataFrame:
    """Collections from CSV; all text, and an empty field stays an empty string."""
    schema = StructType([StructField(n, StringType()) for n in columns])
    return spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True).na.fill("")


def collections_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Collections ordered by type; the href splits ties of a big type."""
    return spark.read.parquet(path).orderBy("type", "href")
