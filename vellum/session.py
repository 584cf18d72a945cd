"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def local_session(cores: int | str = 8, name: str = "vellum") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Only a local master without that setting (tests) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
