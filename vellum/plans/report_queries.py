"""Reports and alerts on orders as tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import reports as R
from vellum.plans.adapters import SQL_TASKS, as_of, sql_percent, table, tasks
from vellum.plans.registry import query

WITH = "WITH " + SQL_TASKS


def _rows(spark, folder):
    return R.report_rows(tasks(spark, folder), as_of())


def _alerts(spark, folder):
    return R.overdue_alerts(tasks(spark, folder), as_of())


@query(
    f"""{WITH} SELECT number, title, task_id, task_url, sync_status, last_sync, pic, checkpoint, department,
    strftime(due, '%d/%m/%Y') AS due_text, days AS days_overdue FROM enriched WHERE is_overdue"""
)
def overdue_tasks(spark, folder):
    columns = ["number", "title", "task_id", "task_url", "sync_status", "last_sync", "pic", "checkpoint", "department", "due_text", "days_overdue"]
    return R.overdue_report(_rows(spark, folder)).select(*columns)


def _group_sql(key: str) -> str:
    return f"""{WITH} SELECT {key}, total, overdue, {sql_percent('overdue', 'total', 0.0)} AS overdue_percent FROM (
      SELECT {key}, count(*) AS total, count(*) FILTER (WHERE is_overdue) AS overdue FROM enriched GROUP BY {key})"""


@query(_group_sql("department"))
def overdue_by_department(spark, folder):
    return R.group_overdue(_rows(spark, folder), "department")


@query(_group_sql("pic"))
def overdue_by_person(spark, folder):
    return R.group_overdue(_rows(spark, folder), "pic")


@query(
    f"""{WITH} SELECT total, completed, {sql_percent('completed', 'total', 0.0)} AS completion_percent FROM (
      SELECT count(*) AS total, count(*) FILTER (WHERE is_completed) AS completed FROM enriched)"""
)
def completion_rate(spark, folder):
    return R.completion_rate(_rows(spark, folder))


@query(f"""{WITH} SELECT CASE WHEN sync_status = '' THEN '(trống)' ELSE sync_status END AS status, count(*) AS count FROM enriched GROUP BY 1""")
def status_counts(spark, folder):
    return R.status_counts(_rows(spark, folder), "sync_status", "(trống)")


@query(
    f"""{WITH} SELECT count(*) AS total, count(*) FILTER (WHERE days >= 7) AS critical,
    count(*) FILTER (WHERE days BETWEEN 3 AND 6) AS warning, count(*) FILTER (WHERE days BETWEEN 1 AND 2) AS info FROM alerts"""
)
def severity_counts(spark, folder):
    return R.severity_counts(_alerts(spark, folder))


@query(
    f"""{WITH} SELECT (SELECT count(*) FROM tasks) AS total_records, count(*) AS tasks,
      count(*) FILTER (WHERE is_overdue) AS overdue_tasks, count(*) FILTER (WHERE is_completed) AS completed_tasks,
      count(DISTINCT department) AS departments, count(DISTINCT pic) AS people,
      {sql_percent('count(*) FILTER (WHERE is_completed)', 'count(*)', 0.0)} AS completion_percent,
      (SELECT string_agg(s || '=' || n, ';' ORDER BY s) FROM (
         SELECT CASE WHEN sync_status = '' THEN '(trống)' ELSE sync_status END AS s, count(*) AS n FROM enriched GROUP BY 1)) AS statuses
    FROM enriched"""
)
def report_summary(spark, folder):
    total = tasks(spark, folder).agg(F.count(F.lit(1)).alias("n")).scalar()
    summary = R.report_summary(_rows(spark, folder), total)
    entries = F.transform(F.array_sort(F.map_entries("status_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return summary.withColumn("statuses", F.array_join(entries, ";")).drop("status_counts")


_RECIPIENTS_SQL = """recipients AS (SELECT 'user' || c_custkey || '@example.org' AS pic FROM customer WHERE c_acctbal > 9000)"""


def _recipients(spark, folder):
    rich = table(spark, folder, "customer").filter("c_acctbal > 9000")
    return rich.select(F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.org")).alias("pic"))


@query(
    f"""{WITH}, {_RECIPIENTS_SQL} SELECT pic, count(*) AS tasks, sum(days)::BIGINT AS days, arg_min(department, _row_number) AS department
    FROM alerts WHERE pic NOT IN (SELECT pic FROM recipients) GROUP BY pic"""
)
def person_digest(spark, folder):
    return R.person_digest(R.exclude_recipients(_alerts(spark, folder), _recipients(spark, folder)))


def _state(spark, folder):
    """Shipped lines as alerts already sent on their ship date."""
    return table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("sent_date"), F.concat(F.lit("T-"), F.col("l_orderkey").cast("string")).alias("task_id"),
        F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("pic"), F.col("l_linenumber").alias("days"),
    )


_STATE_SQL = """state AS (SELECT CAST(l_shipdate AS DATE) AS sent_date, 'T-' || l_orderkey AS task_id, 'p' || l_suppkey AS pic, l_linenumber AS days FROM lineitem)"""


@query(
    f"""{WITH}, {_STATE_SQL} SELECT task_id, pic, days AS days_overdue FROM alerts
    WHERE task_id NOT IN (SELECT task_id FROM state WHERE sent_date = DATE '1998-06-01')"""
)
def alerts_not_sent(spark, folder):
    pending = R.not_sent_today(_alerts(spark, folder), _state(spark, folder), as_of())
    return pending.select("task_id", "pic", "days_overdue")


@query(
    f"""{WITH}, {_STATE_SQL}, merged AS (
      SELECT s.* FROM state s WHERE NOT (sent_date = DATE '1998-06-01' AND task_id IN (SELECT task_id FROM alerts))
      UNION ALL SELECT DATE '1998-06-01', task_id, pic, days FROM alerts)
    SELECT strftime(sent_date, '%Y-%m-%d') AS sent_date, task_id, pic, days FROM merged
    WHERE sent_date IN (SELECT DISTINCT sent_date FROM merged ORDER BY sent_date DESC LIMIT 30)"""
)
def notification_state(spark, folder):
    merged = R.merge_state(_state(spark, folder), _alerts(spark, folder), as_of())
    return merged.select(F.date_format("sent_date", "yyyy-MM-dd").alias("sent_date"), "task_id", "pic", F.col("days").cast("int").alias("days"))


@query(
    f"""{WITH} SELECT CASE WHEN days >= 7 THEN 'critical' WHEN days >= 3 THEN 'warning' ELSE 'info' END AS level,
      CASE WHEN days >= 7 THEN '🔴' WHEN days >= 3 THEN '🟡' ELSE '🔵' END AS icon, count(*) AS tasks, min(days) AS least, max(days) AS most
    FROM alerts GROUP BY 1, 2"""
)
def alert_levels(spark, folder):
    rows = _alerts(spark, folder).withColumn("_a", R.alert_level("days_overdue"))
    return rows.groupBy(F.col("_a.level").alias("level"), F.col("_a.icon").alias("icon")).agg(
        F.count(F.lit(1)).alias("tasks"), F.min("days_overdue").alias("least"), F.max("days_overdue").alias("most")
    )


_ESC = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(
    f"""{WITH}, heads AS (SELECT pic, count(*) AS n FROM alerts GROUP BY pic)
    SELECT pic, -days::BIGINT AS line_ord, _row_number AS row_ord, '<li><a href="' || task_url || '">' || number || '</a> | ' || checkpoint || ' | Hạn: '
      || strftime(due, '%d/%m/%Y') || ' | Quá <b style="color:' || CASE WHEN days >= 7 THEN '#b71c1c' WHEN days >= 3 THEN '#e65100' ELSE '#2e7d32' END
      || '">' || days || ' ngày</b></li>' AS html FROM alerts
    UNION ALL SELECT pic, -4611686018427387904, 0, '<h3>⚠️ Bạn có ' || n || ' văn bản quá hạn trên Planner (01/06/1998)</h3><ul>' FROM heads
    UNION ALL SELECT pic, 4611686018427387904, 0, '</ul><p>Vui lòng vào Planner cập nhật tiến độ.</p>' FROM heads"""
)
def digest_person_lines(spark, folder):
    return R.digest_lines(_alerts(spark, folder), as_of(), "person")


@query(
    f"""{WITH}, heads AS (SELECT pic, count(*) AS n, arg_min(department, _row_number) AS department FROM alerts GROUP BY pic)
    SELECT pic, -days::BIGINT AS line_ord, _row_number AS row_ord, '<li>' || CASE WHEN days >= 7 THEN '🔴' WHEN days >= 3 THEN '🟡' ELSE '🔵' END
      || ' <a href="' || task_url || '">' || number || '</a> | ' || {_ESC.format("substr(title, 1, 40) || '...'")} || ' | ' || checkpoint || ' | Hạn '
      || strftime(due, '%d/%m/%Y') || ' | Quá <b>' || days || ' ngày</b></li>' AS html FROM alerts
    UNION ALL SELECT pic, -4611686018427387904, 0, '<p><b>👤 ' || pic || ' (' || department || ') — ' || n || ' task</b></p><ul>' FROM heads
    UNION ALL SELECT pic, 4611686018427387904, 0, '</ul><hr/>' FROM heads"""
)
def digest_short_lines(spark, folder):
    return R.digest_lines(_alerts(spark, folder), as_of(), "short")
