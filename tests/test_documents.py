"""Documents of odd content, read by tasks as Spark reads whole texts."""

import gzip
import os
import tempfile

from pyspark.sql import functions as F

from terraloom.functions import files
from terraloom.sources import documents
from terraloom.suite import files as suite


def test_texts_as_spark_reads_them(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    bodies = {"a/1.json": "{}".encode(), "a/2.json": "ä\r\nb\n".encode(), "b/c/3.json": b"\xff\xfe broken", "empty.json": b"", "z.json.gz": gzip.compress(b"packed")}
    for name, body in bodies.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(body)
    read = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
    want = read.select(files.below("_metadata.file_path", root).alias("key"), F.col("value").cast("binary").alias("text"))
    monkeypatch.setattr(documents, "BATCH_FILES", 2)
    got = documents.texts(spark, root, root)
    assert sorted(map(tuple, got.select("key", F.col("text").cast("binary")).collect())) == sorted(map(tuple, want.collect()))
    assert not [f for f in got.inputFiles() if files.plain(f).startswith(root)]
    assert documents.texts(spark, [f"{root}/a", f"{root}/b"], root).count() == 3
    assert documents.texts(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp")).count() == 0


def test_small_rows_are_written_by_many_tasks(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df = spark.range(200).select(F.format_string("%d/f.txt", "id").alias("key"), F.concat(F.lit("w"), "id").cast("binary").alias("body")).coalesce(1)
    group = f"put-{root}"
    spark.sparkContext.setJobGroup(group, "")
    suite.put(df, root)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) > 1
    assert sorted(map(tuple, documents.texts(spark, root, root).collect())) == sorted((f"{k}/f.txt", f"w{k}") for k in range(200))
