"""Incremental pick-up of new objects."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from terraloom.functions import files
from terraloom.sources import listing

OBJECT = "path string, modificationTime timestamp, length bigint"


def _seen(spark: SparkSession, manifest: str) -> DataFrame:
    """``path, batch`` of the manifest, which may not be there yet."""
    if not files.exists(manifest):
        return spark.createDataFrame([], "path string, batch bigint")
    return spark.read.schema("path string, batch bigint").parquet(manifest)


def record(spark: SparkSession, prefix: str, manifest: str, listings: str, suffixes=()) -> None:
    """Keep the objects under ``prefix`` that the manifest lacks as one more listing; the tasks list and write them."""
    found = listing.objects(spark, prefix, suffixes=suffixes)
    listing.pending(found, _seen(spark, manifest), "path").write.parquet(f"{listings}/{uuid.uuid4().hex}")


def new_objects(spark: SparkSession, listings: str) -> DataFrame:
    """A stream of the objects of recorded listings."""
    return spark.readStream.schema(OBJECT).option("recursiveFileLookup", "true").parquet(listings)


def start(spark: SparkSession, prefix: str, manifest: str, checkpoint: str, suffixes=()) -> StreamingQuery:
    """Append every object not seen before to the Parquet manifest and stop.

    The objects are listed by tasks into ``<checkpoint>-listings``, and a stream
    reads these listings, so what the driver gets does not follow the objects.  A
    batch that is run again after a failure overwrites its own ``batch`` folder,
    and what other batches have is left out, so no object is listed twice.
    """
    listings = f"{checkpoint}-listings"
    record(spark, prefix, manifest, listings, suffixes)

    def append(batch: DataFrame, number: int) -> None:
        others = _seen(spark, manifest).filter(F.col("batch") != number)
        new = listing.pending(batch.dropDuplicates(["path"]), others, "path")
        new.write.mode("overwrite").parquet(f"{manifest}/batch={number}")

    return (
        new_objects(spark, listings).writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
