"""Versioned register snapshots: data first, then a row in the version table.

A version is one folder, or buckets of which only the touched ones are written anew (see ``buckets``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators.register import upsert_protected
from vellum.sources.buckets import BUCKETS, read_buckets, read_manifest, touched_buckets, write_buckets

VERSIONS = "version long, stream string, batch long"


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Newest committed version, None before the first."""
    try:
        return spark.read.schema("version long").parquet(f"{root}/versions").agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def is_committed(spark: SparkSession, root: str, stream: str, batch: int) -> bool:
    """Whether a batch of a stream already made a version."""
    if latest_version(spark, root) is None:
        return False
    rows = spark.read.schema(VERSIONS).parquet(f"{root}/versions")
    return not rows.filter((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()


def commit(spark: SparkSession, root: str, version: int, stream: str | None = None, batch: int | None = None) -> None:
    """The version row; ``stream`` and ``batch`` say which batch made it."""
    row = spark.createDataFrame([(version, stream, batch)], VERSIONS)
    row.coalesce(1).write.mode("append").parquet(f"{root}/versions")


def write_snapshot(df: DataFrame, root: str, version: int, stream: str | None = None, batch: int | None = None) -> None:
    """Write one version as a whole; a version that was committed before is left as it is.

    A job that dies between the two writes leaves no version row, so its files are
    overwritten by the next attempt.
    """
    spark = df.sparkSession
    known = latest_version(spark, root)
    if known is not None and known >= version:
        return
    df.write.mode("overwrite").parquet(f"{root}/v{version}")
    commit(spark, root, version, stream, batch)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """One version, written as a whole or in buckets."""
    version = latest_version(spark, root) if version is None else version
    if version is None:
        raise ValueError(f"no committed version in {root}")
    manifest = read_manifest(spark, root, version)
    whole = None if manifest is None else read_buckets(spark, root, manifest)
    return spark.read.parquet(f"{root}/v{version}") if whole is None else whole


def upsert_version(
    payloads: DataFrame, root: str, columns: list[str], stream: str | None = None, batch: int | None = None, buckets: int = BUCKETS, **rules
) -> int:
    """The next version: payloads upserted into the buckets that they touch; gives its number.

    A version written as a whole is dealt to buckets first, once.  ``rules`` go to ``upsert_protected``.
    """
    spark = payloads.sparkSession
    before = latest_version(spark, root)
    if before is None:
        raise ValueError(f"no committed version in {root}")
    version, manifest = before + 1, read_manifest(spark, root, before)
    touched = None if manifest is None else touched_buckets(payloads, manifest[0]["buckets"] if manifest else buckets)
    whole = read_snapshot(spark, root, before)
    held = whole if touched is None else read_buckets(spark, root, manifest, touched)
    register = whole.limit(0) if held is None else held
    last = whole.agg(F.max("_row_number")).first()[0] if manifest is None else max((m["last"] for m in manifest), default=None)
    rows = upsert_protected(register, payloads, columns, last_row=last or 1, **rules).drop("action")
    write_buckets(rows, root, version, manifest, touched, buckets)
    commit(spark, root, version, stream, batch)
    return version
