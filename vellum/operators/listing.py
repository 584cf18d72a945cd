"""Listing rows: filters, reject reasons, issue lists, statistics, pairing, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import clean_text, contains_any, document_type, first_hit, normalize_text
from vellum.functions.urls import first_path_token, path_has_any, url_path_filter
from vellum.operators.dedup import dedup_first
from vellum.operators.skew import lookup_anti, lookup_join, position
from vellum.sources.config import RuleSet


def _lower(words: list[str]) -> list[str]:
    return [w.lower() for w in words if w]


def listing_reject_reason(rules: RuleSet, field_code=None, crawl_type_id=None) -> Column:
    """The first rule a listing row fails, blank when it is kept."""
    named = normalize_text("doc_type")
    kind = F.when(named == "", document_type("title")).otherwise(named)
    checks = ~url_path_filter("url", rules.required_paths, rules.excluded_paths, field_code)
    reason = F.when(checks, "required_url_path_contains")
    if crawl_type_id is not None:
        names = F.create_map(*[F.lit(x) for pair in L.DOC_TYPE_ID_TO_NAME.items() for x in pair])
        wanted = F.try_element_at(names, clean_text(crawl_type_id))
        reason = reason.when(wanted.isNotNull() & (kind != "") & (kind != wanted), "doc_type")
    if rules.accepted_doc_types:
        reason = reason.when((kind == "") | ~kind.isin(rules.accepted_doc_types), "doc_type")
    if rules.skip_doc_types:
        reason = reason.when(kind.isin(rules.skip_doc_types), "doc_type")
    return (
        reason.when(contains_any(F.lower(normalize_text("title")), _lower(rules.title_keywords)), "exclude_title_keywords")
        .when(contains_any(F.lower(normalize_text("url")), _lower(rules.url_keywords)), "exclude_url_keywords")
        .when(contains_any(F.lower(normalize_text("doc_number")), _lower(rules.number_keywords)), "exclude_so_hieu_keywords")
        .otherwise("")
    )


def listing_keyword_filter(rules: RuleSet) -> Column:
    """True when no exclusion keyword of the three lists occurs."""
    return ~(
        contains_any(F.lower(normalize_text("title")), _lower(rules.title_keywords))
        | contains_any(F.lower(normalize_text("url")), _lower(rules.url_keywords))
        | contains_any(F.lower(normalize_text("doc_number")), _lower(rules.number_keywords))
    )


def listing_outcomes(listing: DataFrame, rules: RuleSet, scope: list[str], order: list, **ids) -> DataFrame:
    """``outcome`` per row: ``duplicate_url``, a reject reason, or blank for kept.

    A rejected address may come again and is judged again; only a kept one makes later
    rows duplicates, so the first passing row per address is the kept one.  Rows with a
    lower order than it are never duplicates.
    """
    judged = listing.withColumn("_reason", listing_reject_reason(rules, **ids))
    rows = judged.withColumn("_order", F.struct(*[F.col(o) for o in order]))
    firsts = rows.filter("_reason = '' and url <> ''").groupBy(*scope, "url").agg(F.min("_order").alias("_kept"))
    joined = lookup_join(rows, firsts, [*scope, "url"], spread=order)
    duplicate = (F.coalesce(F.col("url"), F.lit("")) == "") | (F.col("_kept") < F.col("_order"))
    outcome = F.when(F.coalesce(duplicate, F.lit(False)), "duplicate_url").otherwise(F.col("_reason"))
    return joined.withColumn("outcome", outcome).drop("_reason", "_order", "_kept")


def filter_stats(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """Input, kept, duplicate and one count per reject reason."""
    known = ["", "duplicate_url", *L.REJECT_REASONS]
    return outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("input_links"),
        F.count_if(F.col("outcome") == "").alias("kept_links"),
        F.count_if(F.col("outcome") == "duplicate_url").alias("duplicate_url"),
        *[F.count_if(F.col("outcome") == r).alias(r) for r in L.REJECT_REASONS],
        F.count_if(~F.col("outcome").isin(known)).alias("other"),
    )


def branch_summary(fields: DataFrame) -> DataFrame:
    """Documents, pages and announced total per crawl branch."""
    return fields.select(
        "field_code", "field_name", "crawl_doc_type_id",
        F.coalesce("total_count_from_first_page", F.lit(0)).alias("announced_total"),
        "document_count", "page_count", "filter_debug_stats",
    )


def page_debug_summary(pages: DataFrame) -> DataFrame:
    """Pages, documents on them, and pages without any; needs ``document_count``."""
    return pages.agg(
        F.count(F.lit(1)).alias("page_count"),
        F.coalesce(F.sum("document_count"), F.lit(0)).cast("long").alias("document_count"),
        F.count_if(F.col("document_count") == 0).alias("empty_page_count"),
    )


def main_column_rows() -> Column:
    """Row left of the side bar: ``left`` at most 0.72 of a known width."""
    return ~((F.col("viewport_width") > 0) & (F.col("left") > F.col("viewport_width") * 0.72))


def main_column_anchors() -> Column:
    """Anchor left of the side bar and below the page head."""
    return ~((F.col("viewport_width") > 0) & (F.col("left") > F.col("viewport_width") * 0.75)) & (F.col("top") >= 220)


def row_marker_filter(lines: Column, text: Column, required_fields: list[str], hints: list[str] | None = None, marker: str = L.FIELD_MARKER) -> Column:
    """A numbered line or a navigation hint; and, where the row names fields, a required one."""
    numbered = F.exists(lines, lambda x: F.regexp_like(x, F.lit(r"^\d{1,4}\s+")))
    shown = numbered | contains_any(text, hints or L.ROW_NAVIGATION_HINTS)
    wanted = [f.strip().lower() for f in required_fields if f.strip()]
    if not wanted:
        return shown
    low = F.lower(text)
    return shown & ~(F.contains(low, F.lit(marker)) & ~contains_any(low, wanted))


def pair_by_rank(text_rows: DataFrame, link_rows: DataFrame, page: list[str], rules: RuleSet | None = None) -> DataFrame:
    """Join numbered text rows and links of a page by rank; leftover links follow.

    A pair needs a title and an address that no earlier pair used.  Both sides need a
    whole-number ``ord`` that is their order on the page.
    """
    left = position(text_rows, page, "ord", "_rank").select(*page, "_rank", F.col("number").alias("row_number"), F.col("title").alias("_title"))
    right = position(link_rows, page, "ord", "_rank")
    passes = url_path_filter("url", rules.required_paths, rules.excluded_paths) if rules else F.lit(True)
    pairs = right.join(left, [*page, "_rank"]).filter((normalize_text("_title") != "") & (F.col("url") != "") & passes)
    used = dedup_first(pairs, [*page, "url"], ["_rank"])
    matched = used.select(*page, "url", normalize_text("_title").alias("title"), "row_number", F.col("ord").alias("link_ord"))
    urls = used.select(*page, "url")
    rest = lookup_anti(link_rows, urls, [*page, "url"], ["ord"]).filter(normalize_text("title") != "")
    leftovers = rest.select(*page, "url", normalize_text("title").alias("title"), F.lit(None).cast("int").alias("row_number"), F.col("ord").alias("link_ord"))
    return matched.unionByName(leftovers)


def listing_order(df: DataFrame, before: list[str] | None = None) -> DataFrame:
    """Row number (blank last), place on the page, address."""
    return df.orderBy(*(before or []), F.col("row_number").asc_nulls_last(), "row_top", "url")


def capped_documents(df: DataFrame, order: str, max_documents: int) -> DataFrame:
    """The first rows in input order; 0 means no limit."""
    return df.orderBy(order).limit(max_documents) if max_documents > 0 else df


# --- validation of listing rows and payloads -------------------------------------------
def _joined(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value)


def _url_errors(url: Column, rules: RuleSet, lead: str) -> list[Column]:
    token = first_path_token(url, rules.excluded_paths)
    required = path_has_any(url, rules.required_paths) if rules.required_paths else F.lit(True)
    blocked = first_hit(F.lower(clean_text(url)), rules.blocked_url_keywords)
    return [
        F.when(token != "", _joined(f"{lead}excluded_path:", token)),
        F.when(~required, F.lit(f"{lead}not_in_required_paths")),
        _joined(f"{lead}blocked_url_keyword:", blocked),  # NULL without a hit
    ]


def _text_errors(title: Column, number: Column, rules: RuleSet, lead: str) -> list[Column]:
    words = [w.strip().lower().strip(";") for w in rules.title_keywords]
    by_title = first_hit(F.lower(clean_text(title)), [w for w in words if w])
    by_number = first_hit(F.upper(clean_text(number)), [w.strip().upper() for w in rules.number_keywords if w.strip()])
    return [
        _joined(f"{lead}title_keyword:", by_title),
        _joined(f"{lead}number_keyword:", by_number),
    ]


def listing_errors(rules: RuleSet) -> Column:
    """All failing rules of a listing row; without an address only that one."""
    url, kind = clean_text("url"), clean_text("doc_type")
    failing = F.array(
        *_url_errors(url, rules, ""),
        *_text_errors(F.col("title"), F.col("doc_number"), rules, ""),
        F.when(kind.isin(rules.skipped), _joined("skipped_doc_type:", kind)),
        F.when((kind != "") & ~kind.isin(rules.accepted), _joined("not_accepted_doc_type:", kind)),
    )
    return F.when(url == "", F.array(F.lit("missing_url"))).otherwise(F.array_compact(failing))


def listing_warnings() -> Column:
    missing = [F.when(clean_text(c) == "", F.lit(f"missing_{c}")) for c in ["doc_type", "doc_number", "title"]]
    return F.when(clean_text("url") == "", F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*missing)))


def payload_errors(rules: RuleSet) -> Column:
    """All failing rules of a payload row."""
    kind, url = clean_text("doc_type"), clean_text("url")
    by_type = (
        F.when(kind == "", F.lit("missing_doc_type"))
        .when(kind.isin(rules.skipped), _joined("skipped_doc_type:", kind))
        .when(~kind.isin(rules.accepted), _joined("invalid_doc_type:", kind))
    )
    by_url = [F.when(url != "", e) for e in _url_errors(url, rules, "")]
    return F.array_compact(
        F.array(
            by_type,
            F.when(clean_text("title") == "", F.lit("missing_title")),
            F.when(clean_text("number") == "", F.lit("missing_number")),
            F.when(url == "", F.lit("missing_url")),
            *by_url,
            *_text_errors(F.col("title"), F.col("number"), rules, ""),
        )
    )


def issue_counts(df: DataFrame, errors: str = "errors", warnings: str = "warnings") -> DataFrame:
    """Rows, rows with errors and rows with warnings, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.size(errors) > 0).alias("invalid"),
        F.count_if(F.size(warnings) > 0).alias("warned"),
        F.count_if((F.size(errors) == 0) & (F.size(warnings) == 0)).alias("clean"),
    )
