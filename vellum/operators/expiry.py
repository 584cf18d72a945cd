"""Expiry clauses in document texts, and the daily list of what has expired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.dates import latest_date_text
from vellum.functions.html import strip_tags
from vellum.functions.text import clean_text, contains_any, document_numbers, first_hit


def plain_text(html) -> Column:
    """Tags to blanks, white space collapsed; nothing else is removed."""
    return F.regexp_replace(strip_tags(html), r"\s+", " ")


def find_section(text, names: list[str] | None = None, block_end: str = L.EXPIRY_BLOCK_END) -> Column:
    """Block of the first named section, to the next article, chapter, capital run or the end."""
    c = F.col(text) if isinstance(text, str) else text
    blocks = [
        F.nullif(F.regexp_extract(c, rf"((?iu:{n})[\s\S]*?){block_end}", 1), F.lit("")) for n in names or L.EXPIRY_SECTIONS
    ]
    return F.coalesce(*blocks, F.lit(""))


def split_sentences(df: DataFrame, block: str, keep: list[str], min_length: int = 10) -> DataFrame:
    """One row per sentence of the block, split on full stop or semicolon."""
    rows = df.select(*keep, F.posexplode(F.split(block, "[.;]")).alias("sentence_no", "_s"))
    named = rows.select(*keep, F.col("sentence_no").cast("long"), clean_text("_s").alias("sentence"))
    return named.filter(F.length("sentence") >= min_length)


def keyword_reason(sentence, strong: list[str] | None = None) -> Column:
    """First strong keyword in list order, NULL without any."""
    return first_hit(F.lower(F.col(sentence)), strong or L.EXPIRY_STRONG)


def is_partial(sentence, partial: list[str] | None = None) -> Column:
    return contains_any(F.lower(F.col(sentence)), partial or L.EXPIRY_PARTIAL)


def expiry_status(partial: Column, day: Column, as_of: Column) -> Column:
    return (
        F.when(partial, L.EXPIRY_MANUAL)
        .when(day.isNull(), L.EXPIRY_NO_DATE)
        .when(day > as_of, L.EXPIRY_FUTURE)
        .otherwise(L.EXPIRY_WAITING)
    )


def scan_expired(
    docs: DataFrame,
    as_of: Column,
    sections: list[str] | None = None,
    strong: list[str] | None = None,
    partial: list[str] | None = None,
) -> DataFrame:
    """One log row per (new document, sentence, old number).

    ``docs``: ``number, title, url, html, fetch_error``.  Each document stays in its own
    row until its few matching sentences are out, so nothing is shuffled and the whole
    text is read.  A failed read gives one row to check by hand.
    """
    web = docs.filter(F.contains(F.lower(F.coalesce("url", F.lit(""))), F.lit("http")))
    failed = web.filter(clean_text("fetch_error") != "").select(
        F.lit("").alias("old_number"), F.col("number").alias("new_number"), F.col("title").alias("new_title"),
        F.lit(L.EXPIRY_FETCH_REASON).alias("reason"), F.lit("").alias("applied_date"),
        F.lit(L.EXPIRY_FETCH_FAILED).alias("status"),
        F.concat(F.lit("Chi tiết lỗi: "), F.col("fetch_error")).alias("sentence"),
        F.lit(False).alias("is_partial"), F.lit(-1).cast("long").alias("sentence_no"),
    )
    read = web.filter(clean_text("fetch_error") == "").select("number", "title", plain_text("html").alias("_text"))
    # no filter on the block: an empty one gives no sentence, and a filter would be pushed
    # down and read the whole text a second time
    block = read.select("number", "title", find_section("_text", sections).alias("_block"))
    rows = split_sentences(block, "_block", ["number", "title"])
    rows = rows.withColumn("reason", keyword_reason("sentence", strong)).filter("reason is not null")
    rows = rows.withColumns({"is_partial": is_partial("sentence", partial), "_latest": latest_date_text("sentence")})
    cited = rows.withColumn("old_number", F.explode(document_numbers("sentence", L.EXPIRY_NUMBER_PATTERN)))
    cited = cited.filter(F.lower("old_number") != F.lower(F.coalesce("number", F.lit(""))))
    found = cited.select(
        "old_number", F.col("number").alias("new_number"), F.col("title").alias("new_title"), "reason",
        F.col("_latest.spelling").alias("applied_date"),
        expiry_status(F.col("is_partial"), F.col("_latest.day"), as_of).alias("status"),
        "sentence", "is_partial", "sentence_no",
    )
    return found.unionByName(failed)


def expiry_log_rows(found: DataFrame, detected_at: Column, dry_run: bool = True) -> DataFrame:
    """Scan rows in the 14 columns of the expiry log."""
    return found.select(
        detected_at.alias("detected_at"), "old_number", F.lit("").alias("old_title"), "new_number", "new_title", "reason",
        "applied_date", "status", "sentence",
        F.when(F.col("is_partial"), L.EXPIRY_YES).otherwise(L.EXPIRY_NO).alias("is_partial"),
        F.lit("TRUE" if dry_run else "FALSE").alias("dry_run"), F.lit("").alias("deleted_at"),
        F.lit("").alias("row_json"), F.lit(L.EXPIRY_NOTE).alias("note"),
    )


def with_due(log: DataFrame, as_of: Column) -> DataFrame:
    """``is_due`` of each waiting log row: its date has come, or it has none."""
    text = clean_text("applied_date")
    day = F.try_to_date(F.replace(text, F.lit("-"), F.lit("/")), "d/M/yyyy")
    waiting = clean_text("status").isin(L.EXPIRY_WAITING, L.EXPIRY_FUTURE)
    return log.withColumn("is_due", waiting & ((text == "") | F.coalesce(day <= as_of, F.lit(False))))


def expiry_due(log: DataFrame, as_of: Column) -> DataFrame:
    """Distinct numbers to retire now, with how many log rows name them."""
    due = with_due(log, as_of).filter(F.col("is_due") & (clean_text("old_number") != ""))
    return due.groupBy(clean_text("old_number").alias("old_number")).agg(F.count(F.lit(1)).alias("log_rows"))
