"""Overdue reports, digests and once-per-day alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.tasks import alert_level
from vellum.functions.text import clean_text, percent, short_text
from vellum.operators.skew import lookup_anti
from vellum.operators.tasks import enrich_task, sync_back_filter


def report_rows(tasks: DataFrame, as_of: Column) -> DataFrame:
    """Enriched rows that count in reports: with a task, not deleted."""
    return enrich_task(tasks.filter(sync_back_filter()), as_of)


def overdue_report(rows: DataFrame) -> DataFrame:
    """Overdue rows, most days first, then number."""
    return rows.filter("is_overdue").orderBy(F.desc("days_overdue"), "number", "task_id")


def overdue_alerts(tasks: DataFrame, as_of: Column, threshold: int = 1) -> DataFrame:
    """Rows overdue by at least ``threshold`` days for alerts; deleted tasks count as done."""
    rows = tasks.filter((clean_text("task_id") != "") & ~clean_text("sync_status").isin(L.ALERT_COMPLETED))
    enriched = enrich_task(rows, as_of, fallback_split=False)
    # on the due date alone: a filter on the derived columns would read the date three times
    return enriched.filter(F.col("due_date") <= F.date_sub(as_of, max(int(threshold), 1)))


def group_overdue(rows: DataFrame, key: str) -> DataFrame:
    """Total, overdue and overdue percent per department or person; the blank key stays."""
    grouped = rows.groupBy(clean_text(key).alias(key)).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("is_overdue")).alias("overdue")
    )
    return grouped.withColumn("overdue_percent", percent("overdue", "total", 0.0)).orderBy(
        F.desc("overdue"), F.desc("overdue_percent"), key
    )


def completion_rate(rows: DataFrame) -> DataFrame:
    counted = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("is_completed")).alias("completed"))
    return counted.withColumn("completion_percent", percent("completed", "total", 0.0))


def status_counts(df: DataFrame, column: str, blank: str) -> DataFrame:
    text = clean_text(column)
    label = F.when(text == "", F.lit(blank)).otherwise(text)
    return df.groupBy(label.alias("status")).agg(F.count(F.lit(1)).alias("count"))


def severity_counts(alerts: DataFrame) -> DataFrame:
    days = F.col("days_overdue")
    return alerts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(days >= L.ALERT_CRITICAL_DAYS).alias("critical"),
        F.count_if((days >= L.ALERT_WARNING_DAYS) & (days < L.ALERT_CRITICAL_DAYS)).alias("warning"),
        F.count_if((days >= 1) & (days < L.ALERT_WARNING_DAYS)).alias("info"),
    )


def report_summary(rows: DataFrame, total_records: Column) -> DataFrame:
    """Totals, distinct departments and persons, and the status map.

    Groups are counted first, so the distinct counts run over groups and not rows; the
    map's keys are the fixed set of task statuses.
    """
    status = F.when(clean_text("sync_status") == "", F.lit(L.BLANK_STATUS)).otherwise(clean_text("sync_status"))
    groups = rows.groupBy("department", "pic", status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("is_overdue")).alias("overdue"),
        F.count_if(F.col("is_completed")).alias("completed"),
    )
    statuses = groups.groupBy("status").agg(F.sum("n").alias("n")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("m")
    )
    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tasks"),
        F.coalesce(F.sum("overdue"), F.lit(0)).alias("overdue_tasks"),
        F.coalesce(F.sum("completed"), F.lit(0)).alias("completed_tasks"),
        F.count_distinct("department").alias("departments"),
        F.count_distinct("pic").alias("people"),
    )
    return totals.select(
        total_records.alias("total_records"), "*", percent("completed_tasks", "tasks", 0.0).alias("completion_percent"),
        statuses.scalar().alias("status_counts"),
    )


# --- alerts -------------------------------------------------------------------------------
def not_sent_today(alerts: DataFrame, state: DataFrame, as_of: Column, force: bool = False) -> DataFrame:
    """Alerts whose task has no entry for the day; ``force`` passes all."""
    if force:
        return alerts
    sent = state.filter(F.col("sent_date") == as_of)
    return lookup_anti(alerts, sent, ["task_id"], ["_row_number"])


def exclude_recipients(alerts: DataFrame, recipients: DataFrame) -> DataFrame:
    """Persons who get the summary get no digest of their own; ``recipients`` holds ``pic``."""
    return lookup_anti(alerts, recipients, ["pic"], ["_row_number"])


def person_digest(alerts: DataFrame) -> DataFrame:
    """Per person: tasks, sum of days, first department; most days first.

    The tasks themselves stay in rows, see ``digest_lines``.
    """
    return _person_totals(alerts).orderBy(F.desc("days"), "pic")


def _person_totals(alerts: DataFrame) -> DataFrame:
    """Numbers are added up per person and department first, which needs no sort of the alerts; the
    first department (no row number before the least) is taken from those groups."""
    row = F.when(F.count_if(F.col("_row_number").isNull()) == 0, F.min("_row_number"))
    groups = alerts.groupBy("pic", "department").agg(
        F.count(F.lit(1)).alias("_tasks"), F.sum("days_overdue").alias("_days"), row.alias("_row")
    )
    return groups.groupBy("pic").agg(
        F.sum("_tasks").alias("tasks"), F.sum("_days").alias("days"), F.min(F.struct("_row", "department"))["department"].alias("department")
    )


def _escape(c: Column) -> Column:
    for raw, safe in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def _link() -> Column:
    return F.concat(F.lit('<a href="'), _escape(F.col("task_url")), F.lit('">'), _escape(F.col("number")), F.lit("</a>"))


def digest_lines(alerts: DataFrame, as_of: Column, kind: str = "person") -> DataFrame:
    """HTML digests in rows ``(pic, line_ord, row_ord, html)``, to be read in that order per person.

    Kinds: ``person`` (own list), ``summary`` (table) and ``short`` (one-line list).  A
    person's lines stay rows, so a person with very many tasks is no single cell.
    """
    day = F.date_format(as_of, "dd/MM/yyyy")
    days = F.col("days_overdue").cast("string")
    style = alert_level("days_overdue")
    name = _escape(short_text("title", 40))
    step, due = _escape(F.col("checkpoint")), F.col("due_text")
    heads = _person_totals(alerts)
    who, dept, count = _escape(F.col("pic")), _escape(F.col("department")), F.col("tasks").cast("string")
    if kind == "person":
        head = F.concat(F.lit("<h3>⚠️ Bạn có "), count, F.lit(" văn bản quá hạn trên Planner ("), day, F.lit(")</h3><ul>"))
        body = F.concat(
            F.lit("<li>"), _link(), F.lit(" | "), step, F.lit(" | Hạn: "), due, F.lit(' | Quá <b style="color:'),
            style["days_colour"], F.lit('">'), days, F.lit(" ngày</b></li>"),
        )
        tail = F.lit("</ul><p>Vui lòng vào Planner cập nhật tiến độ.</p>")
    elif kind == "summary":
        head = F.concat(F.lit("<div><b>👤 "), who, F.lit(" | "), dept, F.lit(" | "), count, F.lit(" task quá hạn</b></div><table>"))
        cells = [_link(), name, step, due, days, style["icon"]]
        body = F.concat(F.lit('<tr style="background-color: '), style["row_colour"], F.lit(';">'),
                        *[x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))], F.lit("</tr>"))
        tail = F.lit("</table>")
    elif kind == "short":
        head = F.concat(F.lit("<p><b>👤 "), who, F.lit(" ("), dept, F.lit(") — "), count, F.lit(" task</b></p><ul>"))
        body = F.concat(F.lit("<li>"), style["icon"], F.lit(" "), _link(), F.lit(" | "), name, F.lit(" | "), step, F.lit(" | Hạn "),
                        due, F.lit(" | Quá <b>"), days, F.lit(" ngày</b></li>"))
        tail = F.lit("</ul><hr/>")
    else:
        raise ValueError(f"unknown digest kind {kind}")
    lines = alerts.select("pic", (-F.col("days_overdue")).cast("long").alias("line_ord"), F.col("_row_number").alias("row_ord"), body.alias("html"))
    low, high = F.lit(-(2**62)).cast("long"), F.lit(2**62).cast("long")
    zero = F.lit(0).cast("long").alias("row_ord")
    ends = F.array(F.struct(low.alias("line_ord"), zero, head.alias("html")), F.struct(high.alias("line_ord"), zero, tail.alias("html")))
    return heads.select("pic", F.inline(ends)).unionByName(lines)


def state_rows(processed: DataFrame, as_of: Column) -> DataFrame:
    """State entries of alerts just sent, one per task."""
    newest = F.max(F.struct("_row_number", "pic", "days_overdue"))
    sent = processed.groupBy("task_id").agg(newest.alias("_s"))
    return sent.select(as_of.alias("sent_date"), "task_id", F.col("_s.pic").alias("pic"), F.col("_s.days_overdue").alias("days"))


def merge_state(state: DataFrame, processed: DataFrame, as_of: Column, dates: int = L.STATE_DATES_KEPT) -> DataFrame:
    """State with today's entries replaced per task, and only the newest dates kept.

    Which dates those are follows from the date columns alone, before the entries are compared.
    """
    today = state_rows(processed, as_of)
    least = _least_kept(state.select("sent_date").unionByName(today.select("sent_date")), "sent_date", dates)
    kept = state.filter(F.col("sent_date") >= least)
    old = kept.join(today.select("sent_date", "task_id"), ["sent_date", "task_id"], "left_anti")
    return old.unionByName(today.filter(F.col("sent_date") >= least))


def _least_kept(dates_frame: DataFrame, date: str, dates: int) -> Column:
    """The least of the newest ``dates`` distinct dates, one value found before the rows are read."""
    newest = dates_frame.select(date).distinct().orderBy(F.desc(date)).limit(dates)
    return newest.agg(F.min(date)).scalar()


def keep_newest_dates(state: DataFrame, date: str, dates: int = L.STATE_DATES_KEPT) -> DataFrame:
    """Rows of the newest ``dates`` distinct dates; on a state kept by date only their partitions are read."""
    return state.filter(F.col(date) >= _least_kept(state, date, dates))


def save_state(state: DataFrame, path: str) -> None:
    """One partition per date; only the dates present in ``state`` are rewritten."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sent_date").parquet(path)
