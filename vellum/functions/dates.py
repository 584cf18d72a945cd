"""Date text of several spellings, and due dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import clean_text, col

_ZONE_END = r"(?:Z|[+-]\d{2}:?\d{2})$"


# Text of another shape is ruled out by cheap tests first: a failed parse costs an
# exception per row.  Functions with a leading underscore expect stripped text.
def _day(text: Column) -> Column:
    shape = (F.length(text) <= 10) & F.contains(text, F.lit("/"))
    return F.when(shape, F.try_to_date(text, "d/M/yyyy"))


def _is_iso(text: Column) -> Column:
    return (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-") & (F.length(text) >= 10)


def _iso_written(text: Column) -> Column:
    """Date and time of ISO text as written, without its zone."""
    return F.when(_is_iso(text), text.try_cast("timestamp_ntz"))


def _iso_local(text: Column, zone: str) -> Column:
    """ISO text to local wall clock: zoned text is shifted, other text is taken as it is."""
    instant = text.try_cast("timestamp").cast("timestamp_ntz")
    shifted = F.convert_timezone(F.current_timezone(), F.lit(zone), instant)
    zoned = F.endswith(text, F.lit("Z")) | F.regexp_like(F.substring(text, F.lit(11), F.length(text)), F.lit(_ZONE_END))
    return F.when(_is_iso(text), F.when(zoned, shifted).otherwise(text.try_cast("timestamp_ntz")))


def date_of(text) -> Column:
    """``parse_date_value`` for a column that is stripped already."""
    return F.coalesce(_day(col(text)), _iso_local(col(text), L.LOCAL_ZONE).cast("date"))


def day_of(text) -> Column:
    """``parse_day`` for a column that is stripped already."""
    return _day(col(text))


def parse_day(c) -> Column:
    """``d/M/yyyy`` text to DATE; impossible dates and two-digit years are NULL."""
    return _day(clean_text(c))


def parse_date_value(c, zone: str = L.LOCAL_ZONE) -> Column:
    """Day text, else ISO text moved to the local zone."""
    text = clean_text(c)
    return F.coalesce(_day(text), _iso_local(text, zone).cast("date"))


def parse_date_flexible(c) -> Column:
    """Day, day and time, or ISO text; the date is the one written, no zone shift."""
    text = clean_text(c)
    timed = F.when(
        (F.length(text) > 10) & F.contains(text, F.lit("/")), F.try_to_date(text, "d/M/yyyy H:m:s")
    )
    return F.coalesce(_day(text), timed, _iso_written(text).cast("date"))


def parse_cleanup_time(c, zone: str = L.LOCAL_ZONE) -> Column:
    """``d/M/yyyy[ H:m[:s]]`` else ISO text, as local wall clock."""
    text = clean_text(c)
    shape = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?$"
    part = [F.regexp_extract(text, shape, i).try_cast("int") for i in range(1, 7)]
    zero = F.lit(0)
    stamp = F.try_make_timestamp_ntz(
        part[2], part[1], part[0],
        F.coalesce(part[3], zero), F.coalesce(part[4], zero), F.coalesce(part[5], zero).cast("decimal(8,6)"),
    )
    return F.coalesce(F.when(F.regexp_like(text, F.lit(shape)), stamp), _iso_local(text, zone))


def format_day(c) -> Column:
    return F.coalesce(F.date_format(col(c), "dd/MM/yyyy"), F.lit(""))


def format_effective_date(c, zone: str = L.LOCAL_ZONE) -> Column:
    """Any readable date as ``dd/MM/yyyy``; other text stays."""
    text = clean_text(c)
    return F.coalesce(F.date_format(parse_date_value(text, zone), "dd/MM/yyyy"), text)


def next_due(as_of: Column, days=None, fixed: str | None = None) -> Column:
    """Response due date: a number of days from ``as_of`` or a fixed day."""
    if days is not None:
        return F.date_add(as_of, days if isinstance(days, Column) else F.lit(int(days)))
    if fixed is None:
        raise ValueError("give days or a fixed day")
    return parse_day(F.lit(fixed))


def due_utc(c, zone: str = L.LOCAL_ZONE, hour: int = L.DUE_HOUR) -> Column:
    """Day text at the local due hour, as UTC text; unreadable gives blank."""
    local = parse_day(c).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour))
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.coalesce(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def dates_in_text(c) -> Column:
    """All ``d/M/yyyy`` or ``d-M-yyyy`` spellings of a text, in order."""
    return F.regexp_extract_all(
        F.coalesce(col(c), F.lit("")),
        F.lit(r"(?:^|[^0-9A-Za-z_])(\d{1,2}[/-]\d{1,2}[/-]\d{4})"),
        F.lit(1),
    )


def latest_date_text(c) -> Column:
    """The greatest valid date of a text: struct of its date and its spelling."""
    found = F.transform(
        dates_in_text(c),
        lambda s: F.struct(F.try_to_date(F.replace(s, F.lit("-"), F.lit("/")), "d/M/yyyy").alias("day"), s.alias("spelling")),
    )
    valid = F.filter(found, lambda p: p["day"].isNotNull())
    latest = F.array_max(F.transform(valid, lambda p: p["day"]))
    return F.struct(
        latest.alias("day"),
        F.coalesce(
            F.get(F.transform(F.filter(valid, lambda p: p["day"] == latest), lambda p: p["spelling"]), F.lit(0)),
            F.lit(""),
        ).alias("spelling"),
    )
