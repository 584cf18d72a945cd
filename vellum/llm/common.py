"""Small helpers of the operators: tables, staged results, text columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from vellum.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
#: Whether the shuffle files of a query go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends, lost executors lose nothing.

    The shuffles of the write end with it; else their files stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    with _cleanup(spark):
        df.write.option("compression", compression).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def staged_by(df: DataFrame, key: str, least: int, compression: str = "snappy") -> DataFrame:
    """Like ``staged``, in at least ``least`` buckets of a key: what groups by it reads them without a shuffle."""
    spark = df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    buckets = min(max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    empty = spark.createDataFrame([], df.schema).write.bucketBy(buckets, key)
    empty.option("path", f"{shared_folder(spark)}/{name}").option("compression", compression).format("parquet").saveAsTable(name)
    with _cleanup(spark):
        df.write.insertInto(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files lie outside the warehouse
    return rows


@contextmanager
def _cleanup(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the byte-wise path of lower()."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def sql_text(value: str) -> str:
    """A string literal for a SQL text."""
    return "'" + value.replace("'", "''") + "'"


def plus(schema: StructType, **fields: str) -> StructType:
    """A schema with more fields, given by name and type name."""
    return StructType([*schema, *(StructField(k, _of_name(v)) for k, v in fields.items())])


def _of_name(name: str) -> DataType:
    kinds = {"int": IntegerType, "long": LongType, "double": DoubleType, "binary": BinaryType, "string": StringType, "boolean": BooleanType}
    return kinds[name]()
