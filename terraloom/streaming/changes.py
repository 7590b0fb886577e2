"""New, changed and unchanged objects over repeated listings.

Every listing is recorded as a snapshot; a stream reads the snapshots.  The
manifest holds the size and time last seen of every path: each batch is compared
with it in one shuffle, writes its sightings and a new version, then switches a pointer
to it, so a reader sees the old manifest or the new one and nothing between.  A
batch that runs again after a failure writes the same folders again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from terraloom.functions import files

SNAPSHOT = "path string, length bigint, modified timestamp, run bigint"
CHANGE = f"{SNAPSHOT}, status string, old_length bigint"


def record(listing: DataFrame, folder: str, run: int) -> None:
    """Keep a listing (``path, length, modificationTime``) as snapshot ``run``; the same number replaces it."""
    listing.select(
        "path", F.col("length").cast("bigint"), F.col("modificationTime").cast("timestamp").alias("modified"), F.lit(run).cast("bigint").alias("run"),
    ).write.mode("overwrite").parquet(f"{folder}/snapshots/{run:09d}")


def _history(sightings: DataFrame, old: DataFrame) -> DataFrame:
    """Objects of a manifest (``_own`` false) and the sightings after it, which count as later."""
    return old.withColumn("_own", F.lit(False)).unionByName(sightings.withColumn("_own", F.lit(True)))


def _told(sightings: DataFrame, old: DataFrame) -> DataFrame:
    """Each sighting with its status against the one before it, that of the manifest first; in the order of the snapshots."""
    now = F.struct("length", "modified")
    seen = F.lag(now).over(Window.partitionBy("path").orderBy("_own", "run"))
    status = F.when(F.col("_seen").isNull(), "new").when(F.col("_seen").eqNullSafe(now), "unchanged").otherwise("changed")
    return _history(sightings, old).withColumn("_seen", seen).filter("_own").select(
        "path", "length", "modified", "run", status.alias("status"), F.col("_seen.length").alias("old_length"))


def _pointer(folder: str) -> tuple[int, int]:
    """(version, the one before it) of the manifest; -1 where there is none."""
    fs, inner = files.filesystem(folder)
    name = f"{inner}/current"
    if not fs.get_file_info(name).is_file:
        return -1, -1
    with fs.open_input_stream(name) as f:
        version, before = f.read().decode().split()
    return int(version), int(before)


def _switch(folder: str, version: int, before: int) -> None:
    fs, inner = files.filesystem(folder)
    with fs.open_output_stream(f"{inner}/.current.{version}") as f:
        f.write(f"{version} {before}".encode())
    fs.move(f"{inner}/.current.{version}", f"{inner}/current")


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``path, length, modified, run``: every object as last seen; the version that the pointer names."""
    version = _pointer(folder)[0] if version is None else version
    if version < 0:
        return spark.createDataFrame([], SNAPSHOT)
    return spark.read.schema(SNAPSHOT).parquet(f"{folder}/manifest/{version:09d}")


def advance(spark: SparkSession, folder: str, then=None) -> None:
    """Work through the snapshots not seen yet and stop; ``then(batch)`` is called after each batch is written."""
    sightings = spark.readStream.schema(SNAPSHOT).option("recursiveFileLookup", "true").parquet(f"{folder}/snapshots")

    def keep(batch: DataFrame, number: int) -> None:
        path = f"{folder}/changes/batch={number}"
        current, before = _pointer(folder)
        base = before if current == number else current  # a batch that runs again starts where it did
        old = manifest(spark, folder, base)
        _told(batch, old).write.mode("overwrite").parquet(path)
        told = spark.read.schema(CHANGE).parquet(path).select(*old.columns)
        # Of a path seen in several snapshots of the batch the last sighting counts.
        last = _history(told, old).groupBy("path").agg(F.max_by(F.struct("length", "modified", "run"), F.struct("_own", "run")).alias("_l"))
        last.select("path", "_l.*").write.mode("overwrite").parquet(f"{folder}/manifest/{number:09d}")
        _switch(folder, number, base)
        if then is not None:
            then(number)

    (
        sightings.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )


def changes(spark: SparkSession, folder: str, *statuses: str) -> DataFrame:
    """Sightings of all batches with their status: ``new``, ``changed`` or ``unchanged``."""
    df = spark.read.schema(CHANGE).option("recursiveFileLookup", "true").parquet(f"{folder}/changes")
    return df.filter(F.col("status").isin(*statuses)) if statuses else df


def gone(spark: SparkSession, folder: str, listing: DataFrame) -> DataFrame:
    """Objects of the manifest that a listing does not have any more."""
    return manifest(spark, folder).join(listing.select("path"), "path", "left_anti")
