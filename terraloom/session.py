"""Session helpers shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()

# Settings a run on a cluster wants as well; anything already set by
# spark-submit wins because only a new local session gets them from here.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "terraloom", **conf) -> SparkSession:
    """A local session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(conf.pop("shuffle_partitions", 8)))
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Falls back to a fresh temporary folder, and stores that choice in the
    session, only in local mode, where driver and tasks share a machine; on a
    cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Needed where the package is neither installed on the cluster nor passed
    with ``--py-files``; the archive travels through Spark's own file service.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), os.path.basename(package)), "zip",
        os.path.dirname(package), os.path.basename(package),
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
