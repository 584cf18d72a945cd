"""Readers and writers of the pipeline's files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum import labels as L
from vellum.functions.jsonx import log_text, redact_json
from vellum.functions.text import clean_text
from vellum.sources.quarantine import file_texts, parsed, parsed_csv, quarantined, readable, with_fault

#: Key under which files hold a field's display name.
NAME_KEY = "ten_linh_vuc"

DOCUMENT = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in [
            "ma_linh_vuc", "url", "title_from_list", "doc_type_from_list",
            "doc_number_from_list", "source_list_url", "root_list_url", "crawl_doc_type_id",
        ]
    ]
    + [T.StructField("page_index", T.IntegerType()), T.StructField("collected_at", T.StringType())]
)
PAGE = T.StructType(
    [
        T.StructField("page_index", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("document_count", T.LongType()),
        T.StructField("new_document_count", T.LongType()),
        T.StructField("total_documents_so_far", T.LongType()),
    ]
)
FIELD = T.StructType(
    [
        T.StructField("ma_linh_vuc", T.StringType()),
        T.StructField("crawl_doc_type_id", T.StringType()),
        T.StructField("list_url", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("total_count_from_first_page", T.LongType()),
        T.StructField("documents", T.ArrayType(DOCUMENT)),
        T.StructField("pages_crawled", T.ArrayType(PAGE)),
        T.StructField("filter_debug_stats", T.MapType(T.StringType(), T.LongType())),
    ]
)
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("created_at", T.StringType()),
        T.StructField("run_mode", T.StringType()),
        T.StructField("crawl_strategy", T.StringType()),
        T.StructField("total_documents", T.LongType()),
        T.StructField("documents", T.ArrayType(DOCUMENT)),
        T.StructField("fields", T.ArrayType(FIELD)),
    ]
)
DEBUG_PAGE = T.StructType(
    [
        T.StructField("page_index", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("page_documents", T.ArrayType(DOCUMENT)),
        T.StructField("skipped_reason", T.StringType()),
        T.StructField("filter_rejections", T.MapType(T.StringType(), T.LongType())),
    ]
)
DEBUG_SCHEMA = T.StructType(
    [
        T.StructField(
            "fields",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("ma_linh_vuc", T.StringType()),
                                        T.StructField("debug_pages", T.ArrayType(DEBUG_PAGE)),
                    ]
                )
            ),
        )
    ]
)
PAYLOAD = T.StructType([T.StructField(label, T.StringType()) for label in L.SHEET_LABELS.values()])
RESULT = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("send_attempt", T.IntegerType()),
    ]
)
BATCH_SCHEMA = T.StructType(
    [
        T.StructField("created_at", T.StringType()),
        T.StructField("dry_run", T.BooleanType()),
        T.StructField("payloads", T.ArrayType(PAYLOAD)),
        T.StructField("results", T.ArrayType(RESULT)),
        T.StructField("rows", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    ]
)
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("run_ts", T.TimestampNTZType()),
        T.StructField("key", T.StringType()),
        T.StructField("number", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("headings", T.ArrayType(T.StringType())),
        T.StructField("examples", T.ArrayType(T.StringType())),
    ]
)
_INTERNAL_DOCUMENT = {
    "ma_linh_vuc": "field_code", "title_from_list": "title",
    "doc_type_from_list": "doc_type", "doc_number_from_list": "doc_number",
}


def _named(schema: T.DataType, name_key: str) -> T.DataType:
    """The schema with the key of a field's display name next to every field code."""
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(_named(schema.elementType, name_key))
    if not isinstance(schema, T.StructType):
        return schema
    fields = []
    for f in schema.fields:
        fields.append(T.StructField(f.name, _named(f.dataType, name_key), f.nullable))
        if f.name == "ma_linh_vuc":
            fields.append(T.StructField(name_key, T.StringType()))
    return T.StructType(fields)


def _internal(df: DataFrame, name_key: str) -> DataFrame:
    return df.withColumnsRenamed({**_INTERNAL_DOCUMENT, name_key: "field_name"})


def shape_listing(raw: DataFrame, keep: list[str] | None = None, name_key: str = NAME_KEY) -> dict[str, DataFrame]:
    """Crawl results, one per row, as flat frames ``documents``, ``fields``, ``pages`` with the columns ``keep``."""
    keep = keep or []
    branches = raw.select(*keep, F.posexplode("fields").alias("branch", "f")).select(*keep, "branch", "f.*")
    fields = branches.withColumns({"document_count": F.size("documents"), "page_count": F.size("pages_crawled")})
    return {
        "documents": _internal(raw.select(*keep, F.inline_outer("documents")).filter("url is not null"), name_key),
        "fields": _internal(fields.drop("documents", "pages_crawled"), name_key),
        "pages": _internal(branches.select(*keep, "branch", "ma_linh_vuc", F.inline("pages_crawled")), name_key),
    }


def shape_listing_debug(raw: DataFrame, keep: list[str] | None = None, name_key: str = NAME_KEY) -> DataFrame:
    """Debug pages, one row each."""
    keep = keep or []
    fields = raw.select(*keep, F.inline("fields"))
    return _internal(fields.select(*keep, "ma_linh_vuc", name_key, F.inline("debug_pages")), name_key)


def shape_batch(raw: DataFrame, keep: list[str] | None = None) -> dict[str, DataFrame]:
    """Submission files as ``payloads`` (internal names), ``results`` and request ``rows``."""
    keep = keep or []
    back = {label: name for name, label in L.SHEET_LABELS.items()}
    return {
        "payloads": raw.select(*keep, F.inline("payloads")).withColumnsRenamed(back),
        "results": raw.select(*keep, F.posexplode("results").alias("ord", "r"), "dry_run").select(*keep, "ord", "r.*", "dry_run"),
        "rows": raw.select(*keep, F.explode("rows").alias("row")),
    }


def shape_register(raw: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Sheet rows with internal names, the target columns and the stored row number."""
    back = {label: name for name, label in L.SHEET_LABELS.items()}
    named = raw.withColumnsRenamed({**back, "_rowNumber": "_row_number"})
    kept = project_to_schema(named, columns or list(L.SHEET_LABELS), extra=[*(keep or []), "_row_number"])
    return kept.withColumn("_row_number", F.col("_row_number").cast("long"))


def listing_rows(texts: DataFrame, name_key: str = NAME_KEY) -> DataFrame:
    return parsed(texts, _named(LISTING_SCHEMA, name_key))


def listing_debug_rows(texts: DataFrame, name_key: str = NAME_KEY) -> DataFrame:
    return parsed(texts, _named(DEBUG_SCHEMA, name_key))


def batch_rows(texts: DataFrame) -> DataFrame:
    return parsed(texts, BATCH_SCHEMA)


def snapshot_rows(texts: DataFrame) -> DataFrame:
    """Lines of a missing-reference snapshot; one without a key is a fault."""
    return with_fault(parsed(texts, SNAPSHOT_SCHEMA), F.col("_parsed.key").isNull(), "no key")


def register_rows(texts: DataFrame, header: list[str]) -> DataFrame:
    """CSV lines of a register sheet; one without a whole row number is a fault."""
    rows = parsed_csv(texts, header)
    return with_fault(rows, F.col("_parsed")["_rowNumber"].try_cast("long").isNull(), "no row number")


def read_listing_result(spark: SparkSession, path: str, name_key: str = NAME_KEY) -> dict[str, DataFrame]:
    """Crawl result as flat frames: ``documents``, ``fields``, ``pages``, and the ``quarantine``.

    ``name_key`` is the key under which the files hold a field's display name.
    """
    rows = listing_rows(file_texts(spark, path), name_key)
    return {**shape_listing(readable(rows, []), name_key=name_key), "quarantine": quarantined(rows, ["source"])}


def read_listing_debug(spark: SparkSession, path: str, name_key: str = NAME_KEY) -> DataFrame:
    """Debug pages, one row each; a missing file gives no rows."""
    return shape_listing_debug(readable(listing_debug_rows(file_texts(spark, path, required=False), name_key), []), name_key=name_key)


def read_payload_batch(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Submission file as ``payloads`` (internal names), ``results``, request ``rows`` and the ``quarantine``."""
    rows = batch_rows(file_texts(spark, path, required=False))
    return {**shape_batch(readable(rows, [])), "quarantine": quarantined(rows, ["source"])}


def read_register(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Register sheet (CSV with header, or Parquet) with internal names and stored row numbers.

    The row number is a column of the file; it is never taken from partition order.  Cells may hold line
    breaks; rows that do not fit the header are in ``register_quarantine``.
    """
    if not path.endswith(".csv"):
        return shape_register(spark.read.parquet(path), columns)
    return shape_register(_sheet(spark, path).filter("_fault is null"), columns)


def register_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a register's CSV that ``read_register`` leaves out, with the reason."""
    return _sheet(spark, path).filter("_fault is not null").select(F.col("_fault").alias("reason"), F.col("_corrupt_record").alias("text"))


def _sheet(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.options(header=True, multiLine=True, escape='"')
    header = reader.csv(path).columns
    if "_rowNumber" not in header:
        raise ValueError(f"no column _rowNumber in {path}")
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, "_corrupt_record"]])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)
    fault = F.when(F.col("_corrupt_record").isNotNull(), "cells do not match the header")
    return with_fault(rows.withColumn("_fault", fault), F.col("_rowNumber").try_cast("long").isNull(), "no row number")


def project_to_schema(df: DataFrame, columns: list[str], extra: list[str] | None = None) -> DataFrame:
    """Target columns in order: absent ones blank, unknown ones dropped."""
    have = set(df.columns)
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")
    return df.select(*[F.col(e) for e in extra or []], *[cell(c).alias(c) for c in columns])


def sheet_columns(spark: SparkSession, path: str | None = None) -> list[str]:
    """Target labels: from a JSON object or list file, else the default 25."""
    if path is None:
        return list(L.SHEET_LABELS.values())
    schema = T.StructType([T.StructField("sheet_columns", T.ArrayType(T.StringType())), T.StructField("_corrupt_record", T.StringType())])
    text = read_text_or_none(spark, path)
    if text is None:
        return list(L.SHEET_LABELS.values())
    parsed = F.from_json(F.lit(text), schema)["sheet_columns"]
    listed = F.from_json(F.lit(text), T.ArrayType(T.StringType()))
    row = spark.range(1).select(parsed.alias("o"), listed.alias("l")).first()
    names = [n.strip() for n in (row["o"] or row["l"] or []) if n and n.strip()]
    return names or list(L.SHEET_LABELS.values())


def read_text_or_none(spark: SparkSession, path: str) -> str | None:
    try:
        row = spark.read.option("wholetext", True).text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row[0] if row else None


def read_previous_snapshot(spark: SparkSession, path: str | None) -> DataFrame:
    """Missing references of the run before; a missing file or broken lines give no rows."""
    if path is None:
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)
    return readable(snapshot_rows(file_texts(spark, path, lines=True, required=False)), [])


def write_report_csv(df: DataFrame, report: str, path: str) -> None:
    """A report with its fixed columns and labels; rows keep the order of the sorted frame.

    A totally sorted frame is written as ordered part files, so no report passes one task.
    """
    labelled = df.select(*[F.col(name).alias(label) for name, label in L.REPORT_COLUMNS[report]])
    labelled.write.mode("overwrite").option("header", True).csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_text_report(lines: DataFrame, path: str) -> None:
    """Lines ``(section, ord, line)`` in order; a total sort keeps file order."""
    lines.orderBy("section", "ord").select("line").write.mode("overwrite").text(path)


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def event_log_rows(
    df: DataFrame, stage: Column, data: Column, max_len: int = L.LOG_TEXT_MAX, keep: list[str] | None = None
) -> DataFrame:
    """Log rows: stage, document columns and redacted JSON cut to its limit."""
    return df.select(
        *(keep or []),
        F.coalesce(stage, F.lit("")).alias("stage"),
        clean_text("number").alias("number"),
        clean_text("title").alias("title"),
        clean_text("doc_type").alias("doc_type"),
        log_text(redact_json(data), max_len).alias("data_json"),
    )


def append_event_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")
