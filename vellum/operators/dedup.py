"""First, longest and best row per key, and stable unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import clean_text, document_number, document_type, match_key, normalize_text
from vellum.operators.skew import first_by


def dedup_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return first_by(df, keys, order)


def dedup_longest(df: DataFrame, keys: list[str], text: str, order: list) -> DataFrame:
    """Longest text per key, the earlier row on a tie."""
    return first_by(df, keys, [F.length(F.coalesce(F.col(text), F.lit(""))).desc(), *order])


def merge_sources(frames: list[DataFrame], keys: list[str], text: str, order: list) -> DataFrame:
    """Union of reads of the same rows; per key the longest text, earlier source on a tie."""
    tagged = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return dedup_longest(merged, keys, text, [F.col("_source"), *order]).drop("_source")


def merge_first(frames: list[DataFrame], keys: list[str], order: list) -> DataFrame:
    """Union of reads of the same rows; per key the first one."""
    tagged = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return first_by(merged, keys, [F.col("_source"), *order]).drop("_source")


def register_index(register: DataFrame) -> DataFrame:
    """One row per match key: the lowest register row that has both id and number."""
    rows = register.select(
        match_key("number").alias("match_key"),
        clean_text("id").alias("matched_id"),
        clean_text("number").alias("matched_number"),
        F.col("_row_number").alias("matched_row"),
    ).filter("matched_id <> '' and matched_number <> '' and match_key <> ''")
    return first_by(rows, ["match_key"], ["matched_row"])


def link_score(text: Column) -> Column:
    """Navigation text -3, a document type +2, a document number +1."""
    name = normalize_text(text)
    return (
        F.when(name.isin(L.NAVIGATION_TEXTS), -3).otherwise(0)
        + F.when(document_type(name) != "", 2).otherwise(0)
        + F.when(document_number(name) != "", 1).otherwise(0)
    )


def primary_link(links: DataFrame, row_key: list[str]) -> DataFrame:
    """Best link of each listing row: score, then length, then order on the page."""
    scored = links.withColumn("score", link_score(F.col("text")))
    return first_by(scored, row_key, [F.desc("score"), F.length("text").desc(), "ord"])


def fallback_title(rows: DataFrame, row_key: list[str]) -> DataFrame:
    """Title where the best link is no title: longest candidate text of the row.

    ``rows`` holds candidates ``(text, ord)``; navigation words do not count, the earliest
    of the longest wins.
    """
    named = rows.withColumn("text", normalize_text("text"))
    named = named.filter(~F.col("text").isin([*L.NAVIGATION_TEXTS, ""]))
    return dedup_longest(named, row_key, "text", ["ord"])


def needs_fallback_title(title) -> Column:
    name = normalize_text(title)
    return (name == "") | name.isin(L.NAVIGATION_TEXTS) | (F.length(name) < 10)


def keyword_union(defaults: list[str], column) -> Column:
    """Default keywords first, then configured ones; cleaned, first of equals kept."""
    from vellum.functions.text import clean_keyword

    both = F.concat(F.array(*[F.lit(d) for d in defaults]), F.transform(column, clean_keyword))
    return F.array_distinct(F.filter(both, lambda k: k != ""))
