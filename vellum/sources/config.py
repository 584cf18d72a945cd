"""Scan rules: read from JSON, expanded to crawl branches, checked."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum import labels as L
from vellum.functions.text import clean_text
from vellum.functions.urls import build_page_url, set_query_param
from vellum.sources.files import NAME_KEY
from vellum.sources.quarantine import file_texts

_STRINGS = T.ArrayType(T.StringType())
_FILTER_FIELDS = [
    "doc_type_ids_to_crawl", "accepted_doc_types",
    "required_url_path_contains", "exclude_url_path_contains", "skip_doc_types",
    "exclude_title_keywords", "exclude_url_keywords", "exclude_so_hieu_keywords",
]


def config_schema(field_key: str) -> T.StructType:
    """Schema of a rule file; ``field_key`` names its list of required field names."""
    texts = [T.StructField(n, T.StringType()) for n in ["run_mode", "crawl_strategy", "list_url"]]
    numbers = [T.StructField(n, T.IntegerType()) for n in ["page_size", "max_pages_per_field", "max_documents_per_run"]]
    filters = T.StructType([T.StructField(n, _STRINGS) for n in [field_key, *_FILTER_FIELDS]])
    return T.StructType([*texts, *numbers, T.StructField("filters", filters)])


@dataclass(frozen=True)
class RuleSet:
    """Filter lists of one run.  Lists are short; they become literals of the plan."""

    required_fields: list[str] = field(default_factory=list)
    doc_type_ids: list[str] = field(default_factory=list)
    accepted_doc_types: list[str] = field(default_factory=list)
    required_paths: list[str] = field(default_factory=list)
    excluded_paths: list[str] = field(default_factory=list)
    skip_doc_types: list[str] = field(default_factory=list)
    title_keywords: list[str] = field(default_factory=list)
    url_keywords: list[str] = field(default_factory=list)
    number_keywords: list[str] = field(default_factory=list)
    run_mode: str = ""
    page_size: int = 20
    max_pages: int = 0
    max_documents: int = 0

    @property
    def accepted(self) -> list[str]:
        named = [t.strip() for t in self.accepted_doc_types if t.strip()]
        return named or L.ACCEPTED_DOC_TYPES

    @property
    def skipped(self) -> list[str]:
        named = [t.strip() for t in self.skip_doc_types if t.strip()]
        return named or L.SKIPPED_DOC_TYPES

    @property
    def blocked_url_keywords(self) -> list[str]:
        """Default keywords first, then the configured ones, cleaned and without repeats."""
        words = [w.strip().lower().strip(";") for w in [*L.BLOCKED_URL_KEYWORDS, *self.url_keywords]]
        return list(dict.fromkeys(w for w in words if w))


def field_rows(texts: DataFrame, keep: list[str], fields_key: str = "fields", name_key: str = NAME_KEY, text: str = "text") -> DataFrame:
    """Field entries of rule files, one row each, as ``expand_fields`` takes them.

    A file lists its fields under ``fields_key``, or is one entry itself if it has a field code. Codes and display
    names may be one text or a list; only ``true`` enables an entry.  Texts that are no JSON objects give no rows.
    """
    v = F.try_parse_json(text)
    listed = F.filter(F.coalesce(F.try_variant_get(v, f"$['{fields_key}']", "array<variant>"), F.array().cast("array<variant>")), lambda f: F.startswith(F.schema_of_variant(f), F.lit("OBJECT")))
    own = F.when(F.try_variant_get(v, "$.ma_linh_vuc", "variant").isNotNull(), F.array(v)).otherwise(F.array().cast("array<variant>"))
    entries = texts.select(*keep, F.posexplode(F.when(F.size(listed) > 0, listed).otherwise(own)).alias("ord", "_f"))

    def texts_of(path: str) -> Column:
        many, one = F.try_variant_get("_f", path, "array<string>"), F.try_variant_get("_f", path, "string")
        values = F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))
        return F.filter(F.transform(values, clean_text), lambda x: x != "")

    kind = F.schema_of_variant(F.try_variant_get("_f", "$.enabled", "variant"))
    return entries.select(
        *keep,
        "ord",
        F.coalesce((kind == "BOOLEAN") & F.try_variant_get("_f", "$.enabled", "boolean"), F.lit(False)).alias("enabled"),
        texts_of("$.ma_linh_vuc").alias("field_codes"),
        texts_of(f"$['{name_key}']").alias("field_names"),
        F.coalesce(F.try_variant_get("_f", "$.list_url", "string"), F.lit("")).alias("list_url"),
        texts_of("$.filters.doc_type_ids_to_crawl").alias("doc_type_ids"),
        texts_of("$.filters.accepted_doc_types").alias("accepted_doc_types"),
    )


def read_field_rows(spark: SparkSession, path: str, fields_key: str = "fields", name_key: str = NAME_KEY) -> DataFrame:
    """Field entries of the rule file; a missing file raises."""
    return field_rows(file_texts(spark, path), [], fields_key, name_key)


def read_scan_config(spark: SparkSession, path: str, field_key: str = "required_field_contains") -> RuleSet:
    """One small JSON object; a missing file raises, and so do filter lists that are not known, as under
    another ``field_key``."""
    names = F.map_keys(F.from_json(F.get_json_object("text", "$.filters"), "map<string,string>"))
    given = file_texts(spark, path).select(names.alias("n")).first()
    unknown = sorted(set((given["n"] if given else None) or []) - {field_key, *_FILTER_FIELDS})
    if unknown:
        raise ValueError(f"unknown filter lists in {path}: {', '.join(unknown)}")
    row = spark.read.schema(config_schema(field_key)).option("multiLine", True).json(path).first()
    if row is None:
        raise ValueError(f"no configuration in {path}")
    lists = row["filters"].asDict() if row["filters"] else {}
    values = [lists.get(n) or [] for n in [field_key, *_FILTER_FIELDS]]
    return RuleSet(
        *values,
        run_mode=row["run_mode"] or "",
        page_size=row["page_size"] or 20,
        max_pages=row["max_pages_per_field"] or 0,
        max_documents=row["max_documents_per_run"] or 0,
    )


def expand_fields(fields: DataFrame) -> DataFrame:
    """Enabled fields, one row per document type id to crawl.

    Without ids they are inferred from the accepted types (unknown ones ignored, repeats
    dropped); a field with neither stays as one row.
    """
    ids = F.create_map(*[F.lit(x) for i, n in L.DOC_TYPE_ID_TO_NAME.items() for x in (n, i)])
    inferred = F.array_distinct(
        F.filter(F.transform("accepted_doc_types", lambda t: F.try_element_at(ids, clean_text(t))), lambda i: i.isNotNull())
    )
    own = F.coalesce(F.col("doc_type_ids"), F.array().cast("array<string>"))
    wanted = F.when(F.size(own) > 0, own).otherwise(F.coalesce(inferred, F.array().cast("array<string>")))
    rows = fields.filter("enabled").withColumn("crawl_doc_type_id", F.explode_outer(wanted))
    url = F.when(
        F.col("crawl_doc_type_id").isNotNull(),
        set_query_param("list_url", "DocTypeId", F.col("crawl_doc_type_id")),
    ).otherwise(F.col("list_url"))
    return rows.withColumn("list_url", url).withColumn(
        "crawl_doc_type_id", F.coalesce("crawl_doc_type_id", F.lit(""))
    )


def page_count(total, page_size) -> Column:
    return F.ceil(F.col(total) / page_size).cast("int") if isinstance(total, str) else F.ceil(total / page_size).cast("int")


def page_frontier(fields: DataFrame, keep: list[str], page_size: int = 20) -> DataFrame:
    """One row per listing page to read: ``ceil(total / size)`` pages per field."""
    pages = page_count("total", page_size)
    rows = fields.filter("total > 0").select(
        *keep, "list_url", F.explode(F.sequence(F.lit(1), pages)).alias("page_index")
    )
    return rows.withColumn("page_url", build_page_url("list_url", "page_index", page_size))


def config_issues(configs: DataFrame) -> DataFrame:
    """Rows ``(…, code, message, severity)`` for each faulty configuration row."""
    clean = lambda c: F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), clean_text), lambda v: v != ""))
    ids = F.array_sort(clean(F.col("doc_type_ids")))
    confirmed = F.array(*[F.lit(i) for i in L.CONFIRMED_DOC_TYPE_IDS])
    missing, extra = F.array_except(confirmed, ids), F.array_except(ids, confirmed)
    named = clean(F.col("accepted_doc_types"))
    accepted = F.when(F.size(named) > 0, named).otherwise(F.array(*[F.lit(t) for t in L.ACCEPTED_DOC_TYPES]))
    untyped = F.array_sort(F.array_except(F.array(*[F.lit(t) for t in L.ACCEPTED_DOC_TYPES]), accepted))
    trailing = F.filter(
        F.transform(F.coalesce(F.col("url_keywords"), F.array().cast("array<string>")), clean_text),
        lambda k: F.endswith(k, F.lit(";")),
    )

    def issue(code: str, message: Column, severity: str) -> Column:
        return F.struct(F.lit(code).alias("code"), message.alias("message"), F.lit(severity).alias("severity"))

    fixed = F.array_compact(
        F.array(
            F.when(
                (F.size(missing) > 0) | (F.size(extra) > 0),
                issue(
                    "CONFIG_DOC_TYPE_IDS_NOT_MATCH_CONFIRMED_SET",
                    F.concat_ws(
                        "; ",
                        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))),
                        F.when(F.size(extra) > 0, F.concat(F.lit("extra: "), F.array_join(extra, ", "))),
                    ),
                    "error",
                ),
            ),
            F.when(
                F.size(untyped) > 0,
                issue("CONFIG_ACCEPTED_DOC_TYPES_MISSING", F.array_join(untyped, ", "), "error"),
            ),
            F.when(
                clean_text("run_mode") == "", issue("CONFIG_RUN_MODE_EMPTY", F.lit("run_mode is blank"), "warning")
            ),
        )
    )
    keywords = F.transform(trailing, lambda k: issue("CONFIG_EXCLUDE_URL_KEYWORD_HAS_SEMICOLON", k, "error"))
    return configs.select("config_id", F.inline(F.concat(fixed, keywords)))
