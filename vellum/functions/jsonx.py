"""JSON text: envelopes, paths with defaults, redaction, whitelists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum import labels as L
from vellum.functions.text import col

_FIRST = ["$", "$.data", "$.result", "$.result.data"]
NESTED = 20
_SECOND = ["$", "$.data", "$.data.data", "$.result", "$.result.data"]


def json_path(c, path: str, default: str | None = None) -> Column:
    value = F.get_json_object(col(c), path)
    return value if default is None else F.coalesce(value, F.lit(default))


def unwrap_records(df: DataFrame, json_col: str, keep: list[str], nested_data: bool = False) -> DataFrame:
    """One row per record object of a response, whatever envelope it came in.

    Envelopes: a list, ``data``, ``result`` or ``result.data``; with ``nested_data``
    also ``data.data``.  Entries that are not objects are dropped.
    """
    variant = F.try_parse_json(json_col)
    paths = _SECOND if nested_data else _FIRST
    records = F.coalesce(*[F.try_variant_get(variant, p, "array<variant>") for p in paths])
    rows = df.select(*keep, F.posexplode(records).alias("pos", "v"))
    return rows.filter(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))).select(
        *keep, F.col("pos").cast("long").alias("ord"), F.to_json("v").alias("record")
    )


_STRING = r'"(?:[^"\\]++|\\.)*+"'


def _balanced(depth: int = NESTED) -> str:
    """Pattern of an object or a list with at most ``depth`` levels of brackets, strings read as such.

    Every repetition is possessive: one pass, without backtracking and without recursion per item.
    """
    plain = rf'[^\[\]{{}}"]++|{_STRING}'
    pattern = rf"[\[{{](?:{plain})*+[\]}}]"
    for _ in range(depth - 1):
        pattern = rf"[\[{{](?:{plain}|{pattern})*+[\]}}]"
    return pattern


def redact_json(c, keys: list[str] | None = None) -> Column:
    """Values of sensitive keys in JSON text are replaced, whatever their type and depth.

    A value is a scalar or a whole object or list, found by its brackets. What cannot be read as a value, because
    brackets do not close or are more than ``NESTED`` deep, is replaced from its opening bracket to the
    end of the text. All else stays as it is written.
    """
    names = "|".join(keys or L.SENSITIVE_KEYS)
    key = rf'(?is)("\s*(?:{names})\s*"\s*:\s*)'
    scalar = rf"{_STRING}|-?[0-9][0-9.eE+\-]*|true|false|null"
    hidden = f'$1"{L.REDACTED}"'
    text = F.regexp_replace(col(c), f"{key}(?:{scalar}|{_balanced()})", hidden)
    return F.regexp_replace(text, key + r"[\[{].*", hidden)


def redact_struct(name: str, schema: T.DataType, keys: list[str] | None = None) -> Column:
    """Rebuild a typed column with every sensitive field, at any level, replaced."""
    barred = {k.lower() for k in (keys or L.SENSITIVE_KEYS)}

    def rebuild(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            fields = [
                (F.lit(L.REDACTED) if f.name.strip().lower() in barred else rebuild(c[f.name], f.dataType)).alias(f.name)
                for f in kind.fields
            ]
            return F.when(c.isNotNull(), F.struct(*fields))
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: rebuild(x, kind.elementType))
        return c

    return rebuild(F.col(name), schema)


def keep_path_keys(path, body) -> Column:
    """JSON object text with only the keys allowed for its path; other paths give NULL."""
    entries = F.from_json(col(body), "map<string,string>")
    allowed = F.create_map(
        *[x for p, keys in L.PATH_KEYS.items() for x in (F.lit(p), F.array(*[F.lit(k) for k in keys]))]
    )
    names = F.try_element_at(allowed, col(path))
    kept = F.map_filter(entries, lambda k, v: F.array_contains(names, k))
    return F.when(names.isNotNull(), F.to_json(kept))


def log_text(c, limit: int = L.LOG_TEXT_MAX) -> Column:
    """Log JSON cut to its length limit with a marker."""
    text = col(c)
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(L.LOG_TRIM_MARKER))
    ).otherwise(text)
