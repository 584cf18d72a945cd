"""Text clean-up and document-number keys as Column expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum import labels as L

BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _accent_table() -> tuple[str, str]:
    """Latin letters that decompose to one ASCII letter, and that letter (rule: NFD)."""
    source, target = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and base[0].isascii():
            source.append(chr(code))
            target.append(base[0])
    return "".join(source) + "Đđ", "".join(target) + "Dd"


ACCENTED, PLAIN = _accent_table()


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """NULL becomes blank; all surrounding white space goes."""
    return F.btrim(F.coalesce(col(c), F.lit("")), F.lit(BLANKS))


def normalize_text(c) -> Column:
    """Non-breaking spaces to spaces, runs of blanks and of newlines to one, stripped."""
    text = F.translate(F.coalesce(col(c), F.lit("")), "\u00a0", " ")
    text = F.regexp_replace(text, r"[ \t]{2,}|\t", " ")  # a single space is one already
    text = F.regexp_replace(text, r"\n{2,}", "\n")
    return F.btrim(text, F.lit(BLANKS))


def once(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once per row, however often the body names it.

    A Column named n times stands n times in the plan; where such Columns feed each other the
    copies multiply, so that a projection outgrows what the JVM compiles.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_text(*cols) -> Column:
    """The first argument that is not blank, else blank."""
    *before, last = [col(c) for c in cols]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in before], last, F.lit(""))


def contains_any(text: Column, words: list[str]) -> Column:
    """True when any literal of a short list occurs in the text.

    One pattern for the whole list: the text expression stands in the plan once.
    """
    if not words:
        return F.lit(False)
    if len(words) == 1:
        return F.contains(text, F.lit(words[0]))
    return F.regexp_like(text, F.lit("|".join(re.escape(w) for w in words)))


def first_hit(text: Column, words: list[str]) -> Column:
    """The first word, in list order, that occurs in the text; NULL when none does."""
    if not words:
        return F.lit(None).cast("string")
    return once(text, lambda t: F.coalesce(*[F.when(F.contains(t, F.lit(w)), F.lit(w)) for w in words]))


def clean_keyword(c) -> Column:
    return F.btrim(F.lower(clean_text(c)), F.lit(";"))


def clean_path_token(c) -> Column:
    return F.btrim(clean_keyword(c), F.lit("/"))


def short_text(c, limit: int, marker: str = "...") -> Column:
    text = col(c)
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(marker))
    ).otherwise(text)


def percent(part, whole, empty: float) -> Column:
    """Share in percent, two decimals, half up, computed in integers."""
    n, d = col(part).cast("long"), col(whole).cast("long")
    twice = F.lit(20000) * n + d
    step = F.lit(2) * F.nullif(d, F.lit(0))
    hundredths = (twice - F.pmod(twice, step)) / step
    return F.when(d == 0, F.lit(float(empty))).otherwise(F.round(hundredths) / F.lit(100.0))


# --- lists held in one cell ---------------------------------------------------------
def unique_list(values) -> Column:
    """Blank entries dropped, first occurrence kept."""
    return F.array_distinct(F.filter(col(values), lambda v: v.isNotNull() & (clean_text(v) != "")))


def split_values(c) -> Column:
    """Split on newline, comma or semicolon; trimmed, no blanks, no repeats."""
    parts = F.split(F.translate(F.coalesce(col(c), F.lit("")), "\r", "\n"), r"[\n,;]+")
    return unique_list(F.transform(parts, clean_text))


# --- document numbers ---------------------------------------------------------------
def document_numbers(c, pattern: str = L.NUMBER_PATTERN) -> Column:
    """All document numbers of a text, in order."""
    return F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(pattern), F.lit(1))


def document_number(c) -> Column:
    """The first document number of a text, else blank."""
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), L.NUMBER_PATTERN, 1)


def canonical_number(c) -> Column:
    """Upper case, tight slashes and hyphens, known suffix variants settled."""
    text = F.upper(normalize_text(c))
    text = F.regexp_replace(text, r"\s*/\s*", "/")
    text = F.regexp_replace(text, r"\s*-\s*", "-")
    variants = "|".join(re.escape(v) for v in L.CIRCULAR_SUFFIX_VARIANTS)
    # one pattern, so that the text stands in the plan once: a third or later part that is a variant
    text = F.regexp_replace(text, rf"(?s)^([^/]*/.*/)(?:{variants})\z", f"$1{L.CIRCULAR_SUFFIX}")
    text = F.regexp_replace(text, r"/N[DĐ][- ]*CP$", "/NĐ-CP")
    return F.regexp_replace(text, r"/QH\s*(\d+)$", "/QH$1")


def tracking_key(c) -> Column:
    """Key for following missing references between runs; keeps hyphens and accents."""
    return F.translate(F.upper(clean_text(c)), "Đđ\u2013\u2014\u2212\u2010 .", "Dd----")


_MARKS = "".join(chr(c) for c in range(0x0300, 0x0370))
_DROPPED = BLANKS + _MARKS + "-\u2010\u2011\u2012\u2013\u2014\u2212."


def match_key(c) -> Column:
    """Key for matching against the register: no accents, dashes, blanks or dots.

    One translate pass: letters map to their base, characters without a target go.
    """
    return F.upper(F.translate(F.coalesce(col(c), F.lit("")), ACCENTED + _DROPPED, PLAIN))


def primary_number(c) -> Column:
    """The number written after the word for "number", else the first one, canonical."""
    text = normalize_text(c)
    marked = F.regexp_extract(text, L.MARKED_NUMBER_PATTERN, 1)
    return canonical_number(first_text(marked, document_number(text)))


def document_type(c, types: list[str] | None = None) -> Column:
    """Type by title prefix, else by whole word anywhere, in list order.

    Each test is one pattern over all types, so the title stands in the plan twice only.
    """
    types = types or L.DOC_TYPE_PREFIXES
    low = [t.lower() for t in types]
    names, any_type = F.array(*[F.lit(t) for t in low]), "|".join(re.escape(t) for t in low)
    title = F.lower(F.regexp_replace(normalize_text(c), r"^\s*\d{1,4}\s*[.)\-:]\s*", ""))
    word = rf"(?:^|[^\p{{L}}0-9_])({any_type})(?=[^\p{{L}}0-9_]|$)"
    by_prefix = F.nullif(F.array_position(names, F.regexp_extract(title, f"^({any_type})", 1)), F.lit(0))
    found = F.regexp_extract_all(title, F.lit(word), F.lit(1))
    by_word = F.array_min(F.transform(found, lambda t: F.array_position(names, t)))
    place = F.coalesce(by_prefix, by_word).cast("int")
    return F.coalesce(F.get(F.array(*[F.lit(t) for t in types]), place - 1), F.lit(""))


def stable_id(number, url) -> Column:
    seed = F.coalesce(F.nullif(col(number), F.lit("")), F.nullif(col(url), F.lit("")))
    return F.coalesce(F.substring(F.md5(seed), 1, 16), F.lit(""))


def sequence_id(n) -> Column:
    number = col(n).cast("string")
    return F.concat(F.lit("VB"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number))


# --- relationship text --------------------------------------------------------------
def canonical_heading(c, aliases: dict[str, list[str]] | None = None) -> Column:
    """Drop counters in brackets and map a known alias prefix to its heading."""
    text = F.btrim(F.regexp_replace(normalize_text(c), r"\(\d+\)", ""), F.lit(BLANKS))
    text = F.regexp_replace(text, r"\s+", " ")
    low = F.lower(text)
    known = [
        F.when(F.startswith(low, F.lit(alias)), F.lit(name))
        for name, variants in (aliases or L.HEADING_ALIASES).items()
        for alias in variants
    ]
    return F.coalesce(*known, text)


def relation_status(c, default: str = L.SUGGESTED) -> Column:
    text = clean_text(c)
    return F.when(text.isin(L.RELATION_STATUSES), text).otherwise(F.lit(default))


def inferred_relation_status(has_data, hint) -> Column:
    return F.when(col(has_data) | (clean_text(hint) != ""), F.lit(L.SUGGESTED)).otherwise(
        F.lit(L.NOT_SCANNED)
    )


def is_noise(c) -> Column:
    return contains_any(F.lower(col(c)), L.NOISE_PHRASES)


def is_heading(c) -> Column:
    return normalize_text(c).isin(L.DIAGRAM_HEADINGS)


def is_relation_item(c) -> Column:
    """Not a heading, long enough, names a number, holds no noise phrase."""
    text = normalize_text(c)
    return (
        ~text.isin(L.DIAGRAM_HEADINGS)
        & (F.length(text) >= 8)
        & (document_number(text) != "")
        & ~is_noise(text)
    )
