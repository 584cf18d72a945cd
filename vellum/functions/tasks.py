"""Task titles, descriptions, checklist entries and alert levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.dates import format_effective_date
from vellum.functions.text import clean_text, col, first_text


DUE_TEXT = r"(?iu)Hạn hoàn thành\s*:\s*(\d{1,2}/\d{1,2}/\d{4})"


def task_title(number, title) -> Column:
    """``[number] title``, cut to the title limit with an ellipsis."""
    prefix = F.concat(F.lit("["), clean_text(number), F.lit("] "))
    name = clean_text(title)
    room = F.greatest(F.lit(L.MAX_TASK_TITLE - 1) - F.length(prefix), F.lit(0))
    whole = F.concat(prefix, name)
    return F.when(
        F.length(whole) > L.MAX_TASK_TITLE, F.concat(prefix, F.substring(name, F.lit(1), room), F.lit("…"))
    ).otherwise(whole)


def task_description(number, title, doc_type, effective_date, url=None) -> Column:
    """Fixed description lines; with ``url`` the older five-line form."""
    day = format_effective_date(effective_date) if url is None else clean_text(effective_date)
    lines = [
        F.concat(F.lit("Số hiệu: "), clean_text(number)),
        F.concat(F.lit("Tên văn bản: "), clean_text(title)),
        F.concat(F.lit("Loại văn bản: "), clean_text(doc_type)),
        F.concat(F.lit("Ngày hiệu lực: "), day),
    ]
    if url is not None:
        lines.append(F.concat(F.lit("Link văn bản: "), clean_text(url)))
    return F.concat_ws("\n", *lines)


def is_http(url) -> Column:
    return F.regexp_like(F.lower(clean_text(url)), F.lit(r"^https?://"))


def reference_key(url) -> Column:
    """Address escaped for use as a reference key, percent sign first."""
    return reduce(
        lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), L.REFERENCE_KEY_ESCAPES, clean_text(url)
    )


def reference_alias(title, url) -> Column:
    name = first_text(clean_text(title), clean_text(url))
    cut = F.concat(F.rtrim(F.substring(name, 1, L.MAX_ALIAS - 3)), F.lit("..."))
    return F.when(F.length(name) > L.MAX_ALIAS, cut).otherwise(name)


def task_url(template: str, task_id, ids: dict[str, str]) -> Column:
    """Fill ``{name}`` places of an address template; blank without template or task."""
    text = reduce(lambda c, kv: F.replace(c, F.lit("{%s}" % kv[0]), F.lit(kv[1])), ids.items(), F.lit(template))
    filled = clean_text(F.replace(text, F.lit("{task_id}"), clean_text(task_id)))
    return F.when((F.lit(template) == "") | (clean_text(task_id) == ""), F.lit("")).otherwise(filled)


def checklist_title(department, pic, due, step=L.FIRST_STEP, label: str = L.DUE_LABEL) -> Column:
    step = step if isinstance(step, Column) else F.lit(step)
    return F.concat(col(department), F.lit(" | "), col(pic), F.lit(f" | {label}: "), col(due), F.lit(" | "), step)


def checklist_title_ok(title) -> Column:
    return F.length(col(title)) <= L.MAX_CHECKLIST_TITLE


def _part(text: Column, n: int) -> Column:
    return clean_text(F.split_part(text, F.lit("|"), F.lit(n)))


def has_four(text: Column) -> Column:
    return F.regexp_like(text, F.lit(r"^(?s:[^|]*\|){3}"))


def parse_checklist_title(c) -> Column:
    """Struct of department, pic, due text and step; NULL below four parts."""
    return F.when(has_four(col(c)), checklist_parts(col(c)))


def checklist_parts(text: Column) -> Column:
    """The struct of ``parse_checklist_title`` for a text known to have four parts."""
    due = F.regexp_extract(F.split_part(text, F.lit("|"), F.lit(3)), DUE_TEXT, 1)
    rest = clean_text(F.regexp_replace(text, r"^(?s:[^|]*\|){3}", ""))
    step = F.regexp_replace(rest, r"\s*\|\s*", " | ")
    return F.struct(
        _part(text, 1).alias("department"),
        _part(text, 2).alias("pic"),
        due.alias("due_text"),
        clean_text(step).alias("step"),
    )


def parse_checklist_item(c) -> Column:
    """As above, but due is all text after the first colon and step is part four only."""
    text = col(c)
    third = F.split_part(text, F.lit("|"), F.lit(3))
    due = F.when(F.contains(third, F.lit(":")), clean_text(F.regexp_replace(third, r"^[^:]*:", ""))).otherwise(F.lit(""))
    return F.when(
        has_four(text),
        F.struct(
            _part(text, 1).alias("department"),
            _part(text, 2).alias("pic"),
            due.alias("due_text"),
            _part(text, 4).alias("step"),
        ),
    )


def split_setting_list(c) -> Column:
    """Delimited setting: commas, semicolons or newlines; without any, white space."""
    text = F.translate(clean_text(c), ";\n", ",,")
    raw = F.when(F.contains(text, F.lit(",")), F.split(text, ",")).otherwise(F.split(text, r"\s+"))
    return F.filter(F.transform(raw, clean_text), lambda v: v != "")


def assignees(ids, emails, departments) -> Column:
    """Array of assignees from three parallel lists; unequal lengths raise on use."""
    a, b, c = split_setting_list(ids), split_setting_list(emails), split_setting_list(departments)
    zipped = F.arrays_zip(a.alias("user_id"), b.alias("email"), c.alias("department"))
    equal = (F.size(a) == F.size(b)) & (F.size(b) == F.size(c))
    return F.when(equal, zipped).otherwise(F.raise_error(F.lit("assignee lists differ in length")))


def alert_level(days) -> Column:
    """Struct of level, icon and colours for a number of days overdue."""

    def style(level: str) -> Column:
        icon, row, text = L.ALERT_STYLES[level]
        return F.struct(
            F.lit(level).alias("level"), F.lit(icon).alias("icon"),
            F.lit(row).alias("row_colour"), F.lit(text).alias("days_colour"),
        )

    d = col(days)
    return (
        F.when(d >= L.ALERT_CRITICAL_DAYS, style("critical"))
        .when(d >= L.ALERT_WARNING_DAYS, style("warning"))
        .otherwise(style("info"))
    )
