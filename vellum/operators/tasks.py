"""Follow-up tasks: candidates, skip reasons, state joined back, updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions import tasks as X
from vellum.functions.dates import date_of, day_of, format_day, parse_date_flexible
from vellum.functions.text import clean_text, first_text
from vellum.operators.skew import lookup_join

RECORD_DATE_COLUMNS = ["status_date", "scanned_at", "last_sync"]


def record_date(columns: list[str] | None = None) -> Column:
    """First readable date of several columns: struct of day, state and raw text."""
    names = columns or RECORD_DATE_COLUMNS
    raws = [clean_text(c) for c in names]
    days = [parse_date_flexible(c) for c in names]
    first_raw = first_text(*raws)
    used = F.coalesce(*[F.when(d.isNotNull(), r) for d, r in zip(days, raws)], first_raw)
    day = F.coalesce(*days)
    state = F.when(day.isNotNull(), "ok").when(first_raw != "", "invalid").otherwise("missing")
    return F.struct(day.alias("day"), state.alias("state"), used.alias("raw"))


def candidate_reason(create_from: Column | None = None, date: Column | None = None, require_eligible: bool = False) -> Column:
    """Why no task is created for a row, blank for candidates."""
    reason = (
        F.when(F.coalesce(F.col("_row_number"), F.lit(0)) == 0, "missing _rowNumber")
        .when(clean_text("number") == "", "missing Số hiệu")
        .when(clean_text("title") == "", "missing Tên văn bản")
        .when(clean_text("task_id") != "", "already has Planner Task ID")
        .when(clean_text("sync_status") == L.TASK_CREATED, "Planner Sync Status already created")
    )
    if create_from is not None:
        day = (record_date() if date is None else date)["day"]
        reason = reason.when(day.isNull(), "không xác định được ngày của record").when(
            day < create_from,
            F.concat(
                F.lit("ngày record "), F.date_format(day, "yyyy-MM-dd"), F.lit(" < PLANNER_CREATE_FROM_DATE "),
                F.date_format(create_from, "yyyy-MM-dd"),
            ),
        )
    if require_eligible:
        reason = reason.when(~is_eligible(), "status_not_eligible")
    return reason.otherwise("")


def is_eligible() -> Column:
    """Transferred by process status or checked by approval status."""
    return F.contains(F.lower(clean_text("process_status")), F.lit(L.TRANSFERRED_TEXT)) | F.contains(
        F.lower(clean_text("approval_status")), F.lit(L.CHECKED_TEXT)
    )


def skip_category(reason: str = "reason", date: Column | None = None) -> Column:
    """Category of a skip reason; needs the row's task and status columns."""
    r = F.col(reason)
    deleted = clean_text("sync_status") == L.TASK_DELETED
    has_task = clean_text("task_id") != ""
    state = (record_date() if date is None else date)["state"]
    unknown_day = r == "không xác định được ngày của record"
    return (
        F.when(F.startswith(r, F.lit("missing ")), "missing_required_field")
        .when((r == "already has Planner Task ID") & deleted, "deleted_planner_task")
        .when(r == "already has Planner Task ID", "has_planner_task_id")
        .when(F.startswith(r, F.lit("ngày record ")), "before_create_from_date")
        .when(unknown_day & (state == "missing"), "missing_create_date")
        .when(unknown_day & (state == "invalid"), "invalid_create_date")
        .when(r.isin("status_not_eligible", "not_transferred_or_not_eligible"), "status_not_eligible")
        .when(r == "Planner Sync Status already created", "unknown")
        .when(deleted, "deleted_planner_task")
        .when(has_task, "has_planner_task_id")
        .when(~is_eligible(), "status_not_eligible")
        .otherwise("unknown")
    )


def candidates(register: DataFrame, create_from: Column | None = None, limit: int = 0, order: str = "_row_number") -> DataFrame:
    """Rows to create tasks for, in row order; 0 is no limit."""
    rows = register.filter(candidate_reason(create_from) == "")
    return rows.orderBy(order).limit(limit) if limit > 0 else rows


def sync_back_filter() -> Column:
    """Has a task and is not marked deleted."""
    return (clean_text("task_id") != "") & (clean_text("sync_status") != L.TASK_DELETED)


def task_outbox(rows: DataFrame, department: str, email: str, due: Column) -> DataFrame:
    """One row per task to create: title, description, checklist entry, reference, due time."""
    day = format_day(due)
    title = X.checklist_title(F.lit(department), F.lit(email), day)
    return rows.select(
        "_row_number",
        X.task_title("number", "title").alias("task_title"),
        X.task_description("number", "title", "doc_type", "effective_date").alias("description"),
        title.alias("checklist_title"),
        X.checklist_title_ok(title).alias("checklist_ok"),
        F.when(X.is_http("url"), X.reference_key("url")).otherwise(F.lit("")).alias("reference_key"),
        F.when(clean_text("url") != "", X.reference_alias("title", "url")).otherwise(F.lit("")).alias("reference_alias"),
        ((clean_text("url") == "") | X.is_http("url")).alias("reference_ok"),
        day.alias("next_due"),
    )


def initial_columns(df: DataFrame, plan_id: str, bucket_id: str, emails: str, now_text: Column) -> DataFrame:
    """The ten columns set when a task was created; needs ``new_task_id, new_task_url, new_due``."""
    return df.withColumns(
        {
            "task_id": F.col("new_task_id"),
            "plan_id": F.lit(plan_id),
            "bucket_id": F.lit(bucket_id),
            "bucket_name": F.lit(L.FIRST_BUCKET),
            "task_url": F.col("new_task_url"),
            "sync_status": F.lit(L.TASK_CREATED),
            "last_sync": now_text,
            "current_pic": F.lit(emails),
            "current_checkpoint": F.lit(L.FIRST_STEP),
            "next_due": F.col("new_due"),
        }
    )


def active_items(items: DataFrame, task: list[str]) -> DataFrame:
    """Per task the first open checklist entry by hint, else the last one with ``all_checked``.

    Entries that do not read as a checklist title do not count.  One map-side combined
    aggregation; no task's entries are collected.
    """
    rows = items.withColumn("p", X.parse_checklist_item("title")).filter("p is not null")
    entry = F.struct(F.col("order_hint").alias("h"), F.col("ord").alias("o"), F.col("p").alias("p"))
    open_entry = F.when(~F.coalesce(F.col("is_checked"), F.lit(False)), entry)
    picked = rows.groupBy(*task).agg(F.min(open_entry).alias("_open"), F.max(entry).alias("_last"))
    item = F.coalesce(F.col("_open.p"), F.col("_last.p"))
    return picked.select(*task, item.alias("item"), F.col("_open").isNull().alias("all_checked"))


def task_update(now_text: Column) -> Column:
    """Struct of cell updates from ``percent_complete, item, all_checked``; NULL cells stay as they are."""
    done = F.coalesce(F.col("percent_complete"), F.lit(0)) == 100
    none = F.col("item").isNull()
    every = F.col("all_checked")
    dept, pic = F.col("item.department"), F.col("item.pic")
    return F.struct(
        F.when(done, L.TASK_DONE).when(none | ~every, L.TASK_WAITING).otherwise(L.CHECKPOINT_DONE).alias("sync_status"),
        now_text.alias("last_sync"),
        F.when(done | none, F.lit(None)).when(dept != "", F.concat(dept, F.lit(" | "), pic)).otherwise(pic).alias("current_pic"),
        F.when(done, F.lit(L.ALL_DONE_TEXT))
        .when(none, F.lit(None))
        .when(every, F.concat(F.lit(L.DONE_PREFIX), F.col("item.step")))
        .otherwise(F.col("item.step"))
        .alias("current_checkpoint"),
        F.when(done | none, F.lit(None)).otherwise(F.col("item.due_text")).alias("next_due"),
    )


def task_state_join(register: DataFrame, heads: DataFrame, actives: DataFrame, now_text: Column) -> DataFrame:
    """Register rows with a task and the updates their task state gives.

    ``outcome`` is ``updated`` or, when the task is gone, ``deleted``.
    """
    rows = register.filter(sync_back_filter())
    tasks = heads.join(actives, "task_id", "left").withColumn("_found", F.lit(True))
    joined = lookup_join(rows.withColumn("task_id", clean_text("task_id")), tasks, ["task_id"], ["_row_number"])
    gone = F.struct(
        F.lit(L.TASK_DELETED).alias("sync_status"), now_text.alias("last_sync"), F.lit(None).cast("string").alias("current_pic"),
        F.lit(None).cast("string").alias("current_checkpoint"), F.lit(None).cast("string").alias("next_due"),
    )
    found = F.col("_found").isNotNull()
    update = F.when(found, task_update(now_text)).otherwise(gone)
    return joined.withColumns({"updates": update, "outcome": F.when(found, "updated").otherwise("deleted")}).drop(
        "_found", "item", "all_checked", "percent_complete"
    )


def update_rows(state: DataFrame) -> DataFrame:
    """Updates as long rows ``(row_number, column, value, ord)`` for ``register.apply_updates``."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"updates.{c}").alias("value"))
        for c in ["sync_status", "last_sync", "current_pic", "current_checkpoint", "next_due"]
    ]
    rows = state.select(F.col("_row_number").alias("row_number"), F.inline(F.array(*cells)))
    return rows.filter("value is not null").withColumn("ord", F.lit(0).cast("long"))


def mark_deleted_tasks(register: DataFrame, heads: DataFrame, now_text: Column) -> DataFrame:
    """Deleted status and sync time where the task no longer exists."""
    known = heads.select("task_id").distinct().withColumn("_found", F.lit(True))
    joined = lookup_join(register.withColumn("_t", clean_text("task_id")), known.withColumnRenamed("task_id", "_t"), ["_t"], ["_row_number"])
    gone = sync_back_filter() & F.col("_found").isNull()
    return joined.withColumns(
        {
            "sync_status": F.when(gone, F.lit(L.TASK_DELETED)).otherwise(F.col("sync_status")),
            "last_sync": F.when(gone, now_text).otherwise(F.col("last_sync")),
        }
    ).drop("_t", "_found")


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Totals of a task run over an ``outcome`` column: skipped, created, failed, waiting."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_records"),
        F.count_if(F.col("outcome") != "skipped").alias("candidate_records"),
        F.count_if(F.col("outcome").isin("created", "failed")).alias("records_to_process"),
        F.count_if(F.col("outcome") == "created").alias("created_tasks"),
        F.count_if(F.col("outcome") == "failed").alias("failed_records"),
    ).withColumn("ok", F.col("failed_records") == 0)


# --- state of a task row for reports ------------------------------------------------------
def enrich_task(
    tasks: DataFrame, as_of: Column, completed: list[str] | None = None, fallback_split: bool = True
) -> DataFrame:
    """Department, person, step, due date, completed, overdue and days overdue per row.

    The checkpoint is read as a checklist title first, then the person column; with
    ``fallback_split`` a person cell ``department | person`` is split.  The due date leaves an
    explode of one entry: a filter on it stays above, and does not take the date's whole reading,
    once per mention, down into the join the rows come from.
    """
    cleaned = tasks.withColumns(
        {"_pic": clean_text("current_pic"), "_step": clean_text("current_checkpoint"), "_due": clean_text("next_due")}
    )
    listed = [F.when(X.has_four(F.col(c)), F.col(c)) for c in ("_step", "_pic")]
    read = cleaned.withColumns({"_list": F.coalesce(*listed), "_cells": F.split("_pic", r"\|")})
    title, parsed = X.checklist_parts(F.col("_list")), F.col("_list").isNotNull()
    read = read.withColumn("_written", title["due_text"])
    read = read.withColumn("due_date", F.explode(F.array(F.coalesce(day_of("_written"), date_of("_due")))))
    cell = lambda n: clean_text(F.get("_cells", F.lit(n)))
    can_split = (F.size("_cells") >= 2) if fallback_split else F.lit(False)
    rows = read.withColumns(
        {
            "department": F.when(parsed, title["department"]).when(can_split, cell(0)).otherwise(F.lit("")),
            "pic": F.when(parsed, first_text(title["pic"], "_pic")).when(can_split, cell(1)).otherwise(F.col("_pic")),
            "checkpoint": first_text(F.coalesce(title["step"], F.lit("")), "_step"),
            "is_completed": clean_text("sync_status").isin(completed or L.REPORT_COMPLETED),
        }
    )
    overdue = F.coalesce((F.col("due_date") < as_of) & ~F.col("is_completed"), F.lit(False))
    rows = rows.withColumn("is_overdue", overdue)
    return rows.withColumns(
        {
            "days_overdue": F.when(F.col("is_overdue"), F.date_diff(as_of, "due_date")).otherwise(F.lit(0)),
            "due_text": format_day("due_date"),
        }
    ).drop("_list", "_written", "_cells", "_pic", "_step", "_due")
