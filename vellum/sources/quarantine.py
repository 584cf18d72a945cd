"""Texts that should hold JSON objects or CSV rows, and what cannot be read of them, with the reason."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHOWN = 500


def file_texts(spark: SparkSession, path: str, lines: bool = False, required: bool = True) -> DataFrame:
    """``(source, text)``: one row per file, or per line; no rows for a missing file that need not be there."""
    try:
        raw = spark.read.option("wholetext", not lines).text(path)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "source string, text string")
    return raw.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def parsed(texts: DataFrame, schema: T.StructType, text: str = "text") -> DataFrame:
    """The rows with ``_parsed``, the object of the schema, and ``_fault``, NULL where the text could be read.

    Faults: ``blank``, ``not JSON``, ``not an object``, ``wrong type: a, b`` (fields of another type) and
    ``wrong type inside`` (parts of fields).  A text with a fault is not read in part.
    """
    whole = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    read = texts.withColumns(
        {"_parsed": F.from_json(text, whole, {"columnNameOfCorruptRecord": "_corrupt_record"}), "_variant": F.try_parse_json(text)}
    )
    given = lambda name: F.coalesce(F.schema_of_variant(F.try_variant_get("_variant", f"$['{name}']", "variant")), F.lit("VOID")) != "VOID"
    wrong = [F.when(given(f.name) & F.col("_parsed")[f.name].isNull(), F.lit(f.name)) for f in schema.fields]
    names = F.array_join(F.array_compact(F.array(*wrong)), ", ")
    fault = (
        F.when(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\r\n")) == "", "blank")
        .when(F.col("_variant").isNull(), "not JSON")
        .when(~F.startswith(F.schema_of_variant("_variant"), F.lit("OBJECT")), "not an object")
        .when(names != "", F.concat(F.lit("wrong type: "), names))
        .when(F.col("_parsed._corrupt_record").isNotNull(), "wrong type inside")
    )
    return read.withColumn("_fault", fault).drop("_variant")


def parsed_csv(lines: DataFrame, header: list[str], text: str = "text") -> DataFrame:
    """The rows with ``_parsed``, the cells under the header's names, and ``_fault``."""
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, "_corrupt_record"]])
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    read = lines.withColumn("_parsed", F.from_csv(F.col(text), ddl, {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE", "escape": "\""}))
    blank = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\r\n")) == ""
    return read.withColumn("_fault", F.when(blank, "blank").when(F.col("_parsed._corrupt_record").isNotNull(), "cells do not match the header"))


def with_fault(rows: DataFrame, wrong: Column, reason: str) -> DataFrame:
    """Another fault for rows that have none yet."""
    return rows.withColumn("_fault", F.coalesce("_fault", F.when(F.coalesce(wrong, F.lit(False)), reason)))


def readable(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the fields of what could be read."""
    return rows.filter("_fault is null").select(*keep, "_parsed.*").drop("_corrupt_record")


def quarantined(rows: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the ``reason`` and the start of the text of what could not."""
    return rows.filter("_fault is not null").select(*keep, F.col("_fault").alias("reason"), F.substring(text, 1, SHOWN).alias("text"))
