"""Register versions in buckets: a version rewrites only the buckets that its payloads touch.

``data/v<n>/_bucket=<b>`` holds the buckets that version ``n`` wrote, ``manifest/v<n>`` says for every bucket of
version ``n`` which version's files hold it, and ``versions`` (see ``snapshots``) commits a version last.
A row's bucket follows from the key by which payloads find it, so a payload reaches its row, or the
place of its new row, in one bucket. Rows without a number are never looked up and are spread by row number.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import clean_text, match_key

BUCKETS = 1024
ROWS_PER_FILE = 1_000_000
MANIFEST = "bucket int, version long, n long, last long, buckets int"


def _bucket_of(text: Column, buckets: int) -> Column:
    key = F.when(match_key(text) == "", text).otherwise(match_key(text))
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def row_bucket(buckets: int) -> Column:
    spread = F.pmod(F.xxhash64(F.col("_row_number").cast("long")), F.lit(buckets)).cast("int")
    return F.when(clean_text("number") == "", spread).otherwise(_bucket_of(clean_text("number"), buckets))


def touched_buckets(payloads: DataFrame, buckets: int) -> list[int]:
    """Buckets in which payloads look for their rows; at most all of them."""
    number = F.coalesce(F.col("number"), F.lit(""))
    both = F.explode(F.array(_bucket_of(clean_text("number"), buckets), _bucket_of(number, buckets)))
    return sorted(r["b"] for r in payloads.filter(clean_text("number") != "").select(both.alias("b")).distinct().collect())


def read_manifest(spark: SparkSession, root: str, version: int) -> list | None:
    """The buckets of a version, one row each; None if it was written as a whole."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v{version}").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_buckets(spark: SparkSession, root: str, manifest: list, only: list[int] | None = None) -> DataFrame | None:
    """Rows of some buckets, or of all; None if they hold none."""
    wanted = None if only is None else set(only)
    paths = [f"{root}/data/v{m['version']}/_bucket={m['bucket']}" for m in manifest if wanted is None or m["bucket"] in wanted]
    return spark.read.parquet(*paths) if paths else None


def write_buckets(rows: DataFrame, root: str, version: int, manifest: list | None = None, only: list[int] | None = None, buckets: int = BUCKETS) -> None:
    """Write the data and the manifest of a version.

    ``rows`` are all rows of the buckets ``only`` (of all buckets, if None); the other buckets stay
    with the files that ``manifest``, that of the version before, names.
    """
    spark = rows.sparkSession
    buckets = manifest[0]["buckets"] if manifest else buckets
    placed = rows.withColumn("_bucket", row_bucket(buckets)).repartition("_bucket", F.expr(f"_row_number div {ROWS_PER_FILE}"))
    placed.write.mode("overwrite").partitionBy("_bucket").parquet(f"{root}/data/v{version}")
    kept = [] if only is None else [tuple(m) for m in manifest or [] if m["bucket"] not in set(only)]
    written = spark.read.schema("_row_number long, _bucket int").parquet(f"{root}/data/v{version}")
    counts = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.max("_row_number").alias("last")).collect()
    fresh = [(r["_bucket"], version, r["n"], r["last"], buckets) for r in counts]
    spark.createDataFrame(kept + fresh, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v{version}")
