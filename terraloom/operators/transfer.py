"""Copying objects, and outcome summaries."""

from __future__ import annotations

import time
import uuid

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from terraloom.functions import files, href as hrefs
from terraloom.session import shared_folder
from terraloom.sources.listing import tasks_of

STATUS = "path string, target string, status string, bytes bigint, seconds double, error string"
CHUNK = 8 * 1024 * 1024


def plan(listing: DataFrame, target: str, root: str = "", flatten: bool = False) -> DataFrame:
    """Where each listed object goes.

    The path below ``root`` is kept; ``flatten`` keeps the base name only, and
    of several objects with one name the first by path is copied while the rest
    count as existing.
    """
    inner = hrefs.base_name(F.col("path")) if flatten else files.below("path", root)
    placed = listing.select("path", "length", F.concat(F.lit(target.rstrip("/") + "/"), inner).alias("target"))
    first = placed.groupBy("target").agg(F.min("path").alias("path"))
    return placed.join(first.withColumn("first", F.lit(True)), ["target", "path"], "left").select(
        "path", "length", "target", F.coalesce("first", F.lit(False)).alias("first")
    )


def copy(planned: DataFrame, tasks: int | None = None) -> DataFrame:
    """Copy files and report ``copied``, ``skipped`` or ``failed`` per row.

    Bytes stream through the tasks in chunks.  Each file is written under a
    temporary name and moved into place, so a lost or repeated task leaves a
    whole file or none.  The copying happens once, here; what comes back is
    the written table of what each file's task reported.  A file that a task
    of this run put in place before it was lost counts as copied.
    """
    began = time.time()

    def move(row):
        if not row.first:
            return "skipped", None
        fs, inner = files.filesystem(row.target)
        there = fs.get_file_info(inner)
        if there.type != pafs.FileType.NotFound:
            mine = there.mtime is not None and there.mtime.timestamp() >= began and there.size == row.length
            return ("copied", there.size) if mine else ("skipped", None)
        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        part = f"{inner}.{time.time_ns()}.part"
        done = 0
        try:
            with files.open_file(row.path) as source, fs.open_output_stream(part) as sink:
                while data := source.read(CHUNK):
                    sink.write(data)
                    done += len(data)
            fs.move(part, inner)
        except Exception:
            if fs.get_file_info(part).type != pafs.FileType.NotFound:
                fs.delete_file(part)
            raise
        return "copied", done

    def run(batches):
        for pdf in batches:
            rows = []
            for row in pdf.itertuples():
                start = time.time()
                try:
                    status, size = move(row)
                    error = None
                except Exception as failure:
                    status, size, error = "failed", None, f"{type(failure).__name__}: {failure}"
                rows.append((row.path, row.target, status, size, time.time() - start, error))
            out = pd.DataFrame(rows, columns=["path", "target", "status", "bytes", "seconds", "error"])
            out["bytes"] = out["bytes"].astype("Int64")
            yield out

    spark = planned.sparkSession
    told = f"{shared_folder(spark)}/copied-{uuid.uuid4().hex}"
    planned.repartition(tasks or tasks_of(planned.sparkSession), "path").mapInPandas(run, STATUS).write.parquet(told)
    return spark.read.parquet(told)


def summary(status: DataFrame, size_mb: str = "size_mb", seconds: str | None = None) -> DataFrame:
    """Files, bytes and speed per outcome; skipped files count as present."""
    out = [F.count(F.lit(1)).alias("files"), F.sum(size_mb).alias("total_mb")]
    if seconds:
        out.append(F.try_divide(F.sum(size_mb), F.sum(seconds)).alias("mb_per_second"))
    return status.groupBy("status").agg(*out)


def by_prefix(status: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Successes and totals per prefix."""
    return status.groupBy(prefix).agg(
        F.count_if(F.col("status") != "failed").alias("succeeded"), F.count(F.lit(1)).alias("files")
    )
