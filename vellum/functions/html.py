"""Page text, links and page classification from HTML columns."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import BLANKS, col, contains_any, normalize_text
from vellum.functions.urls import resolve_url

_HREF = r"""href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_TAG = rf"""<a\s[^>]*?{_HREF}[^>]*>"""
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


#: Names of entities and their code points, as one text to look them up in.
_NAMED = "&" + "&".join(f"{k};{v}" for k, v in name2codepoint.items()) + "&"


def _entity(e: Column) -> Column:
    """The character of one entity; unknown ones stay as they are."""
    at = F.instr(F.lit(_NAMED), e)
    named = F.substring_index(F.substring(F.lit(_NAMED), at + F.length(e), F.lit(8)), "&", 1)
    number = (
        F.when(F.regexp_like(e, F.lit("^&#[xX]")), F.conv(F.regexp_extract(e, "^&#[xX](.*);$", 1), 16, 10))
        .when(F.startswith(e, F.lit("&#")), F.regexp_extract(e, "^&#(.*);$", 1))
        .when(at > 0, named)
        .cast("int")
    )
    known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(number), 8, F.lit("0"))), "UTF-32")).otherwise(e)


def unescape(c) -> Column:
    """Decimal, hexadecimal and named entities to characters, in one pass; texts without ``&`` are left alone."""

    def decoded(text: Column) -> Column:
        between = F.split(text, _ENTITY, -1)
        found = F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), _entity)
        whole = F.zip_with(between, found, lambda b, e: F.concat(b, F.coalesce(e, F.lit(""))))
        return F.when(F.contains(text, F.lit("&")), F.array_join(whole, "")).otherwise(text)

    # An expression is bound once, however often it is named; a column needs no binding.
    return decoded(F.col(c)) if isinstance(c, str) else F.get(F.transform(F.array(c), decoded), F.lit(0))


def strip_tags(c) -> Column:
    return F.regexp_replace(col(c), r"<[^>]*>?", " ")


def html_to_text(c) -> Column:
    """Scripts and styles out, tags to blanks, white space collapsed."""
    body = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?is)<(script|style)\b.*?</(?:script|style)>", " ")
    return F.btrim(F.regexp_replace(unescape(strip_tags(body)), r"[\s\u00a0]+", " "), F.lit(BLANKS))


def html_lines(c) -> Column:
    """Visible text as non-blank lines: block ends and line breaks end a line."""
    body = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?is)<(script|style)\b.*?</(?:script|style)>", " ")
    body = F.regexp_replace(body, r"(?i)<(?:br|/p|/div|/li|/h[1-6]|/tr|/title|/article|/footer|/nav)\b[^>]*>", "\n")
    return text_lines(unescape(strip_tags(body)))


def text_lines(c) -> Column:
    lines = F.transform(F.split(F.coalesce(col(c), F.lit("")), r"\r\n|\n|\r"), normalize_text)
    return F.filter(lines, lambda x: x != "")


def page_title(c) -> Column:
    raw = F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return normalize_text(unescape(raw))


def html_links(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per anchor: its order on the page, absolute address and visible text.

    One pass over the page cuts out the anchors; address and text are then read from the
    start tag alone and from what follows it.  The ``html`` column is dropped here, so that no
    later shuffle carries it.
    """
    anchors = F.regexp_extract_all("html", F.lit(rf"(?is){_TAG}.*?</a>"), F.lit(0))
    rows = pages.select(*keep, F.col("url").alias("page_url"), F.posexplode(anchors).alias("pos", "a"))
    tagged = rows.withColumn("_tag", F.regexp_extract("a", rf"(?is)^{_TAG}", 0))
    quoted = F.regexp_extract("_tag", rf"(?is){_HREF}", 1)
    read = tagged.select(
        *keep, "page_url", "pos", F.regexp_replace(quoted, r"""^["']|["']$""", "").alias("_href"),
        strip_tags(F.expr("substring(a, length(_tag) + 1, length(a) - length(_tag) - 4)")).alias("_text"),
    )
    return read.select(
        *keep,
        (F.col("pos") + 1).cast("long").alias("ord"),
        resolve_url("page_url", unescape("_href")).alias("url"),
        normalize_text(unescape("_text")).alias("text"),
    )


def classify_page(title, text) -> Column:
    """``error_or_empty``, ``updating`` or ``ok``."""
    body = F.lower(normalize_text(text))
    whole = F.concat(F.lower(normalize_text(title)), F.lit("\n"), body)
    return (
        F.when((F.btrim(whole, F.lit(BLANKS)) == "") | contains_any(whole, L.PAGE_ERROR_MARKERS), "error_or_empty")
        .when(contains_any(body, L.PAGE_UPDATING_MARKERS), "updating")
        .otherwise("ok")
    )


def announced_total(c, patterns: list[str] | None = None) -> Column:
    """Announced number of documents: first pattern that reads as a number, else 0."""
    text = normalize_text(c)
    found = [
        F.translate(F.regexp_extract(text, "(?iu)" + p, 1), ".,", "").try_cast("long")
        for p in (patterns or L.TOTAL_COUNT_PATTERNS)
    ]
    return F.coalesce(*found, F.lit(0).cast("long"))
