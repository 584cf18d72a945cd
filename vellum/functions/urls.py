"""URL expressions: parts, query editing, path-token rules, listing page addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import clean_text, col

_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"


def normalize_url(c) -> Column:
    """No fragment, no trailing slash; blank when scheme or host is missing."""
    url = clean_text(c)
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    rest = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    whole = F.concat(scheme, F.lit(":"), F.regexp_replace(rest, r"\?$", ""))
    return F.when(F.regexp_like(url, F.lit(_ABSOLUTE)), F.rtrim(whole, F.lit("/"))).otherwise(F.lit(""))


def url_path(c) -> Column:
    """Lower-case path of any URL text; never raises."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
    return F.lower(F.regexp_extract(clean_text(c), pattern, 1))


def slashed_path(c) -> Column:
    return F.concat(F.lit("/"), F.btrim(url_path(c), F.lit("/")), F.lit("/"))


def _tokens(values: list[str]) -> list[str]:
    return [t for t in (v.strip().lower().strip(";").strip("/") for v in values) if t]


def path_has_any(c, tokens: list[str]) -> Column:
    """Any token equals whole segments of the path."""
    path = slashed_path(c)
    hits = [F.contains(path, F.lit(f"/{t}/")) for t in _tokens(tokens)]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def first_path_token(c, tokens: list[str]) -> Column:
    path = slashed_path(c)
    hits = [F.when(F.contains(path, F.lit(f"/{t}/")), F.lit(t)) for t in _tokens(tokens)]
    return F.coalesce(*hits, F.lit(""))


def url_path_filter(c, required: list[str], excluded: list[str], field_code=None) -> Column:
    """Exclusion wins; without required tokens the field code is the token, else all pass."""
    keep = F.lit(True)
    if _tokens(required):
        keep = path_has_any(c, required)
    elif field_code is not None:
        code = F.btrim(F.lower(clean_text(field_code)), F.lit("/"))
        keep = (code == "") | F.contains(slashed_path(c), F.concat(F.lit("/"), code, F.lit("/")))
    return keep & ~path_has_any(c, excluded)


# --- query string -------------------------------------------------------------------
def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encoded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _pairs(url: Column) -> Column:
    """Query items as structs, one per key: first position, last value."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    items = F.transform(
        F.filter(F.split(query, "&"), lambda i: i != ""),
        lambda i: F.struct(
            _decoded(F.regexp_extract(i, r"^([^=]*)", 1)).alias("k"),
            _decoded(F.regexp_extract(i, r"^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )
    keys = F.array_distinct(F.transform(items, lambda p: p["k"]))
    return F.transform(
        keys,
        lambda k: F.struct(
            k.alias("k"),
            F.element_at(F.filter(items, lambda p: p["k"] == k), -1)["v"].alias("v"),
        ),
    )


def _with_pairs(url: Column, pairs: Column) -> Column:
    text = F.array_join(
        F.transform(pairs, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&"
    )
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    return F.when(text == "", base).otherwise(F.concat(base, F.lit("?"), text))


def _pair(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("k"), value.cast("string").alias("v"))


def _set(pairs: Column, key: str, value: Column) -> Column:
    swapped = F.transform(pairs, lambda p: F.when(p["k"] == key, _pair(key, value)).otherwise(p))
    return F.when(F.exists(pairs, lambda p: p["k"] == key), swapped).otherwise(
        F.concat(pairs, F.array(_pair(key, value)))
    )


def set_query_param(c, key: str, value) -> Column:
    """Replace the parameter where it stands, or append it; the fragment goes."""
    value = value if isinstance(value, Column) else F.lit(str(value))
    return _with_pairs(col(c), _set(_pairs(col(c)), key, value))


def remove_query_param(c, key: str) -> Column:
    return _with_pairs(col(c), F.filter(_pairs(col(c)), lambda p: p["k"] != key))


def build_page_url(c, page_index, page_size) -> Column:
    """Listing address of one page: page size, then page index, at the end."""
    size = page_size if isinstance(page_size, Column) else F.lit(page_size)
    rest = F.filter(_pairs(col(c)), lambda p: ~p["k"].isin("PageIndex", "PageSize"))
    added = F.array(_pair("PageSize", size), _pair("PageIndex", col(page_index)))
    return _with_pairs(col(c), F.concat(rest, added))


def is_document_url(c, host: str, tail: str = L.DOCUMENT_URL_TAIL, fragments=None) -> Column:
    """A page of the given host whose name ends like a document and is no list page."""
    url = normalize_url(c)
    fragments = L.EXCLUDED_URL_FRAGMENTS if fragments is None else fragments
    barred = [F.contains(F.lower(url), F.lit(f)) for f in fragments]
    place = r"(?i)^https?://(?:www\.)?" + host.replace(".", r"\.") + r"/.+?" + tail
    return (
        F.endswith(F.lower(url), F.lit(".html"))
        & F.regexp_like(url, F.lit(place))
        & ~reduce(lambda a, b: a | b, barred, F.lit(False))
    )


def resolve_url(base, href) -> Column:
    """Absolute form of a link found on a page."""
    page, link = col(base), clean_text(href)
    origin = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_query = F.regexp_extract(page, r"^([^?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(no_query, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", ""), r"[^/]*$", "")
    return (
        F.when(link == "", page)
        .when(F.regexp_like(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(page, r"^([^:]*:)", 1), link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
        .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_extract(page, r"^([^#]*)", 1), link))
        .when(F.startswith(link, F.lit("?")), F.concat(no_query, link))
        .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )
