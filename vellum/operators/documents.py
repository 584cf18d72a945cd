"""Document pages to register payloads, and payload gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import (
    canonical_number, clean_text, contains_any, document_number, first_hit, first_text,
    inferred_relation_status, normalize_text, once, relation_status, stable_id,
)
from vellum.sources.config import RuleSet


_LABELS = {"number": "số hiệu", "issuer": "cơ quan ban hành", "field": "lĩnh vực", "validity": "hiệu lực"}


def _first_line(lines: Column, test) -> Column:
    return F.get(F.filter(lines, test), F.lit(0))


def _line_with(low_lines: str, label: str) -> Column:
    """1-based place of the first line that holds the label, 0 without one."""
    return F.array_position(F.transform(low_lines, lambda x: F.contains(x, F.lit(label))), True).cast("int")


def _value_after(lines: Column, at: Column) -> Column:
    """Text after the label's colon, or the next line when the label line has none."""
    line = F.get(lines, at - 1)
    after = normalize_text(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1))
    following = normalize_text(F.coalesce(F.get(lines, at), F.lit("")))
    value = F.when(F.contains(line, F.lit(":")), after).otherwise(following)
    return F.when(at > 0, value).otherwise(F.lit(""))


def _date_in(dated: Column, *words: str) -> Column:
    """The date of the first line, of those with a date, that holds one of the words."""
    line = _first_line(dated, lambda x: contains_any(F.lower(x), list(words)))
    return F.coalesce(F.regexp_extract(line, L.DATE_PATTERN, 1), F.lit(""))


def document_fields(df: DataFrame, lines: str, out: str = "info") -> DataFrame:
    """Number, title, type, issuer, dates, field and validity from the lines of a page.

    Number, title, label places and lines with a date are columns of their own, worked out once per page.
    """
    c = F.col(lines)
    read = df.withColumns({"_low": F.transform(c, F.lower), "_no": document_number(F.array_join(c, "\n"))})
    starts_with = "^(?:" + "|".join(L.TITLE_STARTS) + ")"

    def titled(x: Column) -> Column:
        named = (F.col("_no") != "") & F.contains(x, F.col("_no"))
        return (F.length(x) >= 20) & (named | F.regexp_like(F.lower(x), F.lit(starts_with)))

    placed = read.withColumns(
        {
            **{f"_at_{name}": _line_with("_low", label) for name, label in _LABELS.items()},
            "_dated": F.filter(c, lambda x: F.regexp_like(x, F.lit(L.DATE_PATTERN))),
            "_title": F.coalesce(_first_line(c, titled), F.get(c, F.lit(0)), F.lit("")),
        }
    )
    names = [t.lower() for t in L.PAGE_DOC_TYPES]
    prefix = F.regexp_extract(F.lower("_title"), "^(" + "|".join(names) + ")", 1)
    place = F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), prefix), F.lit(0)).cast("int")
    kind = F.coalesce(F.get(F.array(*[F.lit(t) for t in L.PAGE_DOC_TYPES]), place - 1), F.lit(""))
    value = {name: _value_after(c, F.col(f"_at_{name}")) for name in _LABELS}
    fields = F.struct(
        first_text(value["number"], "_no").alias("number"),
        F.col("_title").alias("title"),
        kind.alias("doc_type"),
        value["issuer"].alias("issuer"),
        _date_in(F.col("_dated"), "ban hành").alias("issued"),
        _date_in(F.col("_dated"), "hiệu lực", "áp dụng").alias("effective_date"),
        value["field"].alias("field"),
        value["validity"].alias("validity"),
    )
    return placed.withColumn(out, fields).drop("_low", "_no", "_title", "_dated", *[f"_at_{name}" for name in _LABELS])


def map_field(df: DataFrame, mapping: DataFrame, column: str, out: str) -> DataFrame:
    """Case-insensitive dictionary lookup; no entry gives blank.

    ``mapping`` holds ``(name, value)``; the first of equal names counts.  Spark chooses
    broadcast or shuffle by the mapping's real size.
    """
    from vellum.operators.skew import first_by

    rows = mapping.select(
        F.lower(normalize_text("name")).alias("_key"), normalize_text("value").alias(out), F.col("name").alias("_n")
    ).filter("_key <> ''")
    unique = first_by(rows, ["_key"], ["_n"]).drop("_n")
    joined = df.withColumn("_key", F.lower(normalize_text(column))).join(unique, "_key", "left").drop("_key")
    return joined.withColumn(out, F.coalesce(out, F.lit("")))


def build_payload(df: DataFrame, source_name: str, include_note: bool = False) -> DataFrame:
    """The 25 register columns; listing values come before page values.

    Needs listing ``doc_type, title, doc_number, url, field_name, field_code,
    source_list_url``, page struct ``info``, ``mapped_field``, the relation columns
    ``basis … relation_note``, ``has_relations``, ``sequence_id`` and ``scanned_at``.
    The number, which id and number column share, is worked out first.
    """
    info, number = F.col("info"), F.col("_payload_number")
    df = df.withColumn("_payload_number", first_text(normalize_text("doc_number"), normalize_text(info["number"])))
    hint = F.coalesce(F.col("basis_hint"), F.lit(""))
    hints = F.size(F.filter(F.split(hint, "\n"), lambda x: clean_text(x) != ""))
    note = F.concat(
        F.lit("Dữ liệu được trích xuất tự động từ Lược đồ trong chế độ batch. Lĩnh vực nguồn: "), normalize_text("field_name"),
        F.lit(". Mã lĩnh vực nguồn: "), normalize_text("field_code"),
        F.lit(". URL danh sách nguồn: "), normalize_text("source_list_url"),
        F.lit(". Số văn bản căn cứ gợi ý: "), hints.cast("string"), F.lit("."),
    )
    blank = F.lit("")
    values = {
        "id": first_text("sequence_id", stable_id(number, normalize_text("url"))),
        "field": F.col("mapped_field"),
        "topic": blank,
        "section": blank,
        "doc_type": first_text(normalize_text("doc_type"), normalize_text(info["doc_type"])),
        "title": first_text(normalize_text("title"), normalize_text(info["title"])),
        "number": canonical_number(number),
        "effective_date": normalize_text(info["effective_date"]),
        "impact": blank,
        "department": blank,
        "url": normalize_text("url"),
        **{c: F.col(c) for c in L.OFFICIAL_COLUMNS},
        "approval_status": F.lit(L.WAITING_CHECK),
        "process_status": F.lit(L.WAITING_AUTO_CHECK),
        "basis_text": F.col("basis_text"),
        "basis_hint": hint,
        "not_in_register": blank,
        "relation_status": relation_status(inferred_relation_status("has_relations", hint), L.NOT_SCANNED),
        "relation_note": F.col("relation_note") if include_note else blank,
        "source": F.lit(source_name),
        "scanned_at": F.col("scanned_at"),
        "scan_note": note,
    }
    return df.select(*[F.coalesce(v, blank).alias(n) for n, v in values.items()])


def payload_required_message(required: list[str] | None = None) -> Column:
    """Blank when valid, else the first missing column."""
    checks = [F.when(normalize_text(c) == "", F.lit(f"missing:{c}")) for c in required or L.REQUIRED_COLUMNS]
    return F.coalesce(*checks, F.lit(""))


def payload_skip_reason(rules: RuleSet) -> Column:
    """First rule that keeps a payload from being sent, with the hit; blank to send."""
    clean = lambda words: [w for w in (x.strip().lower() for x in words) if w]
    accepted = rules.accepted_doc_types or L.ACCEPTED_DOC_TYPES
    by_title = first_hit(F.lower(normalize_text("title")), clean(rules.title_keywords))
    by_url = first_hit(F.lower(normalize_text("url")), [*L.HARD_BLOCKED_URL_KEYWORDS, *clean(rules.url_keywords)])
    words = [w.strip() for w in rules.number_keywords if w.strip()]
    by_number = once(
        F.lower(normalize_text("number")),
        lambda low: F.coalesce(*[F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in words], F.lit(None).cast("string")),
    )
    # without a hit the concat is NULL, and later texts are read only then
    by_words = F.coalesce(
        F.concat(F.lit("exclude_title_keywords:"), by_title),
        F.concat(F.lit("exclude_url_keywords:"), by_url),
        F.concat(F.lit("exclude_so_hieu_keywords:"), by_number),
        F.lit(""),
    )
    return once(
        normalize_text("doc_type"),
        lambda kind: F.when(kind == "", F.lit("missing_doc_type"))
        .when(~kind.isin(accepted), F.concat(F.lit("not_in_accepted_doc_types:"), kind))
        .when(kind.isin(rules.skip_doc_types), F.concat(F.lit("skip_doc_types:"), kind))
        .otherwise(by_words),
    )


def write_gate_code() -> Column:
    """Last gate before a register write: one of four codes, blank to write."""
    kind = clean_text("doc_type")
    words = first_hit(F.lower(F.coalesce("title", F.lit(""))), L.WRITE_GATE_KEYWORDS)
    links = first_hit(F.lower(F.coalesce("url", F.lit(""))), L.WRITE_GATE_KEYWORDS)
    return (
        F.when(clean_text("number") == "", "MISSING_SO_HIEU")
        .when(kind.isin(L.SKIPPED_DOC_TYPES), "SKIP_DOC_TYPE")
        .when(~kind.isin(L.ACCEPTED_DOC_TYPES), "DOC_TYPE_NOT_ACCEPTED")
        .when(words.isNotNull() | links.isNotNull(), "EXCLUDED_KEYWORD")
        .otherwise("")
    )


def write_gate_message() -> Column:
    """Text for the gate code: what was missing, the type, or the first keyword found."""
    title, url = F.lower(F.coalesce("title", F.lit(""))), F.lower(F.coalesce("url", F.lit("")))
    word = once(
        F.struct(title.alias("title"), url.alias("url")),
        lambda t: F.coalesce(
            *[F.when(F.contains(t["title"], F.lit(w)) | F.contains(t["url"], F.lit(w)), F.lit(w)) for w in L.WRITE_GATE_KEYWORDS],
            F.lit(""),
        ),
    )
    return (
        F.when(F.col("gate_code") == "MISSING_SO_HIEU", "Bỏ qua vì thiếu Số hiệu.")
        .when(F.col("gate_code") == "SKIP_DOC_TYPE", F.concat(F.lit("Bỏ qua vì Loại văn bản không dùng: "), clean_text("doc_type")))
        .when(
            F.col("gate_code") == "DOC_TYPE_NOT_ACCEPTED",
            F.concat(F.lit("Bỏ qua vì Loại văn bản không thuộc nhóm dùng cho VBQPPL_Nhap: "), clean_text("doc_type")),
        )
        .when(F.col("gate_code") == "EXCLUDED_KEYWORD", F.concat(F.lit("Bỏ qua vì chứa từ khóa loại trừ: "), word))
        .otherwise("")
    )


def retryable(text, code) -> Column:
    """A failed submission worth another try, by status code or error text."""
    return F.coalesce(F.col(code).isin(L.RETRY_CODES), F.lit(False)) | contains_any(
        F.lower(F.coalesce(F.col(text), F.lit(""))), L.RETRY_MARKERS
    )
