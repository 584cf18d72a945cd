"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vellum.session import shared_folder


def staged(df: DataFrame) -> DataFrame:
    """Write a frame and read it back: its lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def staged_count(df: DataFrame) -> tuple[DataFrame, int]:
    """``staged``, and how many rows were written, counted on the way."""
    seen = Observation()
    frame = staged(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return frame, seen.get["n"]
