"""Register snapshots, task loop, validation, expiry and request checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions import dates as D
from vellum.functions import jsonx as J
from vellum.functions import tasks as X
from vellum.operators import expiry as E
from vellum.operators import register as G
from vellum.operators import tasks as K
from vellum.operators import validation as V
from vellum.plans.adapters import (
    SQL_REGISTER, SQL_TASKS, as_of, number_of, register, sql_number, table, tasks,
)
from vellum.plans.registry import CHECKS, query
from vellum.session import shared_folder
from vellum.sources.files import event_log_rows, project_to_schema
from vellum.sources.snapshots import read_snapshot, upsert_version, write_snapshot
from vellum.streaming.requests import accepted_sights, static_code
from vellum.streaming.requests import daily_once as once_a_day
from vellum.streaming.requests import request_audit as audit

WITH = f"WITH {SQL_REGISTER}"
_NOW = dt.datetime(2023, 12, 1, 9, 0, 0)
COLUMNS = list(L.SHEET_LABELS)[:15] + ["approval_status", "process_status"]


def now():
    return F.lit(_NOW.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


# --- views and transfer -----------------------------------------------------------------------
_VIEW = """CASE WHEN process_status = 'Đã chuyển' THEN 'transferred' WHEN approval_status = 'Không liên quan' THEN 'irrelevant' ELSE 'pending' END"""


@query(
    f"""{WITH} SELECT count(*) AS total, count(*) FILTER (WHERE {_VIEW} = 'transferred') AS transferred, count(*) FILTER (WHERE {_VIEW} = 'irrelevant') AS irrelevant,
      count(*) FILTER (WHERE {_VIEW} = 'pending') AS pending FROM register"""
)
def register_counts(spark, folder):
    return G.register_counts(register(spark, folder))


@query(
    f"""{WITH} SELECT 'pending' AS view_name, _row_number FROM register WHERE {_VIEW} = 'pending' UNION ALL SELECT 'transferred', _row_number FROM register WHERE {_VIEW} = 'transferred'
      UNION ALL SELECT 'irrelevant', _row_number FROM register WHERE approval_status = 'Không liên quan' UNION ALL SELECT 'all', _row_number FROM register"""
)
def status_views(spark, folder):
    return G.status_views(register(spark, folder)).select("view_name", "_row_number")


def _staging(spark, folder):
    """Orders as staging rows; their number is that of the customer, so numbers repeat."""
    c = F.col("o_custkey")
    return table(spark, folder, "orders").select(
        (F.col("o_orderkey") + 2).alias("_row_number"), F.lower(number_of(c + 1990)).alias("number"), F.lit("LV").alias("field"), F.lit("Cao").alias("impact"),
        F.lit("Thông tư").alias("doc_type"), F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") == "P", " ").otherwise("http://x").alias("url"), F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise("BP").alias("department"),
        F.lit(L.WAITING_CHECK).alias("approval_status"), F.lit(L.WAITING_AUTO_CHECK).alias("process_status"), F.lit("").alias("status_date"),
    )


_TRANSFER = f"""staging AS (SELECT o_orderkey + 2 AS _row_number, o_custkey + 1990 AS k, lower({sql_number('o_custkey + 1990')}) AS number,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'url,department' WHEN o_orderstatus = 'P' THEN 'url' WHEN o_orderpriority = '5-LOW' THEN 'department' ELSE '' END AS missing,
    EXISTS (SELECT 1 FROM part WHERE p_partkey = o_custkey + 1990) AS dup FROM orders),
  firsts AS (SELECT k, min(_row_number) AS f FROM staging WHERE missing = '' AND NOT dup GROUP BY k),
  judged AS (SELECT s.*, CASE WHEN missing <> '' THEN 'missing_fields' WHEN dup OR _row_number > f THEN 'duplicate' ELSE 'ok' END AS outcome FROM staging s LEFT JOIN firsts USING (k))"""


@query(f"WITH {_TRANSFER} SELECT _row_number, missing, outcome FROM judged")
def transfer_gate(spark, folder):
    judged = G.classify_transfer(_staging(spark, folder), register(spark, folder))
    return judged.select("_row_number", F.array_join("missing", ",").alias("missing"), "outcome")


@query(
    f"""WITH {_TRANSFER} SELECT _row_number, CASE outcome WHEN 'ok' THEN 'Đã chuyển' WHEN 'duplicate' THEN 'Trùng số hiệu' ELSE 'Cần kiểm tra thủ công' END AS process_status,
      CASE outcome WHEN 'ok' THEN 'Đã kiểm tra' ELSE 'Chờ kiểm tra' END AS approval_status, CASE outcome WHEN 'ok' THEN '01/12/2023 09:00:00' ELSE '' END AS status_date FROM judged"""
)
def transfer_staging(spark, folder):
    marked, _ = G.transfer(_staging(spark, folder), register(spark, folder), F.lit("01/12/2023 09:00:00"))
    return marked.select("_row_number", "process_status", "approval_status", "status_date")


@query(
    f"""WITH {_TRANSFER} SELECT (SELECT max(p_partkey) + 2 FROM part) + row_number() OVER (ORDER BY j._row_number) AS _row_number, number, 'LV' AS field, 'Cao' AS impact,
      'Thông tư' AS doc_type, o_orderpriority AS title, 'http://x' AS url, 'BP' AS department, 'Chờ kiểm tra' AS approval_status,
      'Chờ kiểm tra tự động' AS process_status, '01/12/2023 09:00:00' AS status_date
    FROM judged j JOIN orders ON o_orderkey + 2 = j._row_number WHERE outcome = 'ok'"""
)
def transfer_appended(spark, folder):
    _, moved = G.transfer(_staging(spark, folder), register(spark, folder), F.lit("01/12/2023 09:00:00"))
    return moved


# --- upsert and updates -----------------------------------------------------------------------
def _payloads(spark, folder):
    """Orders as payloads for the register: numbers beyond the register's are new."""
    k = F.col("o_orderkey")
    target = F.col("o_custkey") + F.when(F.col("o_orderstatus") == "O", 1500).otherwise(0)
    text = lambda c: F.col(c).cast("string")
    return table(spark, folder, "orders").select(
        k.alias("ord"), F.when(k % 2 == 0, number_of(target)).otherwise(F.lower(F.replace(number_of(target), F.lit("-"), F.lit(" - ")))).alias("number"),
        F.concat(F.lit("P"), text("o_orderkey")).alias("id"), F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("field"),
        F.concat(F.lit("t"), text("o_orderkey")).alias("title"), F.when(k % 3 == 0, "").otherwise(text("o_orderkey")).alias("department"),
        F.when(k % 5 == 0, "").otherwise(text("o_orderkey")).alias("effective_date"),
    )


_UPSERT_COLUMNS = ["id", "field", "title", "number", "effective_date", "department"]
_UPSERT = f"""payloads AS (SELECT o_orderkey AS ord, o_custkey + CASE WHEN o_orderstatus = 'O' THEN 1500 ELSE 0 END AS t,
    CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'x' END AS odd, 'P' || o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS field,
    't' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderkey::VARCHAR END AS department, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderkey::VARCHAR END AS effective_date FROM orders),
  named AS (SELECT *, CASE WHEN odd = '' THEN {sql_number('t')} ELSE lower(replace({sql_number('t')}, '-', ' - ')) END AS number FROM payloads),
  folded AS (SELECT t, min(ord) AS first_ord, arg_max(title, ord) AS title, arg_max(number, ord) AS number, arg_max(effective_date, ord) AS effective_date, arg_min(id, ord) AS id,
     coalesce(arg_min(field, ord) FILTER (WHERE field <> ''), '') AS field, coalesce(arg_min(department, ord) FILTER (WHERE department <> ''), '') AS department FROM named GROUP BY t),
  upserted AS (
    SELECT r._row_number, CASE WHEN f.t IS NULL OR r.id <> '' THEN r.id ELSE f.id END AS id, CASE WHEN f.t IS NULL OR r.field <> '' THEN r.field ELSE f.field END AS field,
      CASE WHEN f.t IS NULL THEN r.title ELSE f.title END AS title, CASE WHEN f.t IS NULL THEN r.number ELSE f.number END AS number,
      CASE WHEN f.t IS NULL THEN r.effective_date ELSE f.effective_date END AS effective_date,
      CASE WHEN f.t IS NULL OR r.department <> '' THEN r.department ELSE f.department END AS department, CASE WHEN f.t IS NULL THEN 'kept' ELSE 'updated' END AS action
    FROM register r LEFT JOIN folded f ON r.p = f.t
    UNION ALL SELECT (SELECT max(_row_number) FROM register) + row_number() OVER (ORDER BY first_ord), id, field, title, number, effective_date, department, 'inserted'
    FROM folded WHERE t NOT IN (SELECT p FROM register))"""


@query(
    f"""{WITH}, {_UPSERT} SELECT u.*, coalesce(r.topic, '') AS topic, coalesce(r.section, '') AS section, coalesce(r.doc_type, '') AS doc_type, coalesce(r.impact, '') AS impact,
      coalesce(r.url, '') AS url, coalesce(r.basis, '') AS basis, coalesce(r.guided_by, '') AS guided_by, coalesce(r.amends, '') AS amends, coalesce(r.amended_by, '') AS amended_by,
      coalesce(r.approval_status, '') AS approval_status, coalesce(r.process_status, '') AS process_status, coalesce(r.status_date, '') AS status_date
    FROM upserted u LEFT JOIN register r ON u._row_number = r._row_number"""
)
def upsert_protected(spark, folder):
    return G.upsert_protected(register(spark, folder), _payloads(spark, folder), _UPSERT_COLUMNS)


@query(CHECKS["upsert_protected"].replace("SELECT u.*,", "SELECT u.* EXCLUDE (action),"))
def upsert_buckets(spark, folder):
    """The same payloads into a register held in buckets, in two batches: each writes a version."""
    root = f"{shared_folder(spark)}/register-{uuid.uuid4().hex}"
    write_snapshot(register(spark, folder), root, 0)
    payloads = _payloads(spark, folder)
    half = payloads.agg(F.expr("(min(ord) + max(ord)) div 2")).first()[0] or 0
    for batch, rows in enumerate((payloads.filter(F.col("ord") <= half), payloads.filter(F.col("ord") > half))):
        upsert_version(rows, root, _UPSERT_COLUMNS, "orders", batch, buckets=64)
    return read_snapshot(spark, root)


@query(
    f"""{WITH}, {_UPSERT} SELECT u._row_number, CASE WHEN u.action = 'updated' AND r.title <> '' THEN r.title ELSE u.title END AS title, u.action
    FROM upserted u LEFT JOIN register r ON u._row_number = r._row_number"""
)
def upsert_only_blank(spark, folder):
    rows = G.upsert_protected(register(spark, folder), _payloads(spark, folder), _UPSERT_COLUMNS, only_blank=True)
    return rows.select("_row_number", "title", "action")


@query(
    f"""{WITH}, u AS (SELECT l_partkey + 2 AS _row_number, l_linenumber, 'v' || l_orderkey || '-' || l_linenumber AS v,
       row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_orderkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
    SELECT r._row_number, coalesce((SELECT v FROM u WHERE u._row_number = r._row_number AND l_linenumber = 1 AND rn = 1), r.title) AS title,
      coalesce((SELECT v FROM u WHERE u._row_number = r._row_number AND l_linenumber = 2 AND rn = 1), r.impact) AS impact, r.process_status, r.topic FROM register r"""
)
def apply_updates(spark, folder):
    line = F.col("l_linenumber")
    value = F.concat(F.lit("v"), F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string"))
    updates = table(spark, folder, "lineitem").select(
        (F.col("l_partkey") + 2).alias("row_number"),
        F.when(line == 1, "title").when(line == 2, "impact").when(line == 3, "process_status").otherwise("unknown").alias("column"),
        F.when(line == 3, L.IRRELEVANT).otherwise(value).alias("value"), F.struct("l_orderkey", "l_suppkey", "l_extendedprice").alias("ord"),
    )
    return G.apply_updates(register(spark, folder), updates, ["title", "impact", "process_status"]).select("_row_number", "title", "impact", "process_status", "topic")


@query(
    f"""{WITH} SELECT _row_number, CASE WHEN p_size % 2 = 0 THEN status_date WHEN approval_status <> 'Không liên quan' THEN '' WHEN status_date = '' THEN '01/12/2023 09:00:00' ELSE status_date END AS status_date FROM register"""
)
def stamp_status_date(spark, folder):
    sized = register(spark, folder).join(table(spark, folder, "part").select((F.col("p_partkey") + 2).alias("_row_number"), "p_size"), "_row_number")
    return G.stamp_status_date(sized, F.col("p_size") % 2 == 1, F.lit("01/12/2023 09:00:00")).select("_row_number", "status_date")


@query(
    f"""{WITH} SELECT _row_number, approval_status, status_date FROM register WHERE NOT (approval_status = 'Không liên quan' AND status_date <> ''
      AND date_diff('second', strptime(nullif(status_date, ''), '%d/%m/%Y %H:%M:%S'), TIMESTAMP '2023-12-01 09:00:00') >= 90 * 86400)"""
)
def purge_irrelevant(spark, folder):
    return G.purge_irrelevant(register(spark, folder), now()).select("_row_number", "approval_status", "status_date")


@query(f"{WITH} SELECT _row_number, effective_date FROM register")
def register_by_date(spark, folder):
    return G.sort_register(register(spark, folder)).select("_row_number", "effective_date")


@query("SELECT event_id, user_id FROM events ORDER BY event_id DESC LIMIT 5000")
def newest_log_rows(spark, folder):
    return G.keep_newest(table(spark, folder, "events").select("event_id", "user_id"), "event_id")


@query(f"{WITH} SELECT id, title, '' AS topic, '' AS unknown_column, number FROM register")
def project_schema(spark, folder):
    return project_to_schema(register(spark, folder), ["id", "title", "topic", "unknown_column", "number"])


@query(
    """SELECT event_id, event_type AS stage, 'N' || user_id AS number, CASE WHEN length(j) > 160 THEN substr(j, 1, 160) || e'\\n...<trimmed_to_prevent_error>' ELSE j END AS data_json FROM (
      SELECT event_id, event_type, user_id, '{"user":"u' || user_id || '","token":"[REDACTED]","cookies":"[REDACTED]","nested":{"Password":"[REDACTED]","k":' || regexp_extract(props, '[0-9]+') || ',"session":"[REDACTED]"},"type":"' || event_type || '"}' AS j FROM events)"""
)
def event_log(spark, folder):
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    data = F.to_json(F.struct(
        user.alias("user"), F.concat(F.lit('s"'), user).alias("token"), F.array(user, F.lit("]")).alias("cookies"),
        F.struct(
            F.lit(17).alias("Password"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.struct(F.array(F.struct(user.alias("id")))).alias("session")
        ).alias("nested"),
        F.col("event_type").alias("type"),
    ))
    rows = table(spark, folder, "events").select(
        "event_id", "event_type", data.alias("data"), F.concat(F.lit("N"), F.col("user_id").cast("string")).alias("number"), F.lit("").alias("title"), F.lit("").alias("doc_type")
    )
    return event_log_rows(rows.withColumn("stage", F.col("event_type")), F.col("stage"), F.col("data"), 160, keep=["event_id"]).select(
        "event_id", "stage", "number", "data_json"
    )


# --- expiry -----------------------------------------------------------------------------------
def _expired(spark, folder):
    """Numbers of ordered parts that shipped before 1995-03."""
    old = table(spark, folder, "lineitem").filter("l_shipdate < TIMESTAMP_NTZ '1995-03-01 00:00:00'")
    return old.select(F.lower(number_of(F.col("l_partkey"))).alias("number"))


_EXPIRED = f"""gone AS (SELECT DISTINCT {sql_number('l_partkey')} AS number FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-03-01')"""


_CELLS = " UNION ALL ".join(
    f"""SELECT _row_number, '{c}' AS c, {c} AS cell, trim(unnest(regexp_split_to_array({c}, '[\\n,;]+'))) AS v,
      generate_subscripts(regexp_split_to_array({c}, '[\\n,;]+'), 1) AS i FROM register"""
    for c in ["basis", "guided_by", "amends"]
)


def _cell_sql(c: str) -> str:
    return f"max(CASE WHEN c = '{c}' THEN CASE WHEN m < n THEN coalesce(left_, '') ELSE cell END END) AS {c}"


@query(
    f"""{WITH}, {_EXPIRED}, cells AS ({_CELLS}),
    marked AS (SELECT *, v IN (SELECT number FROM gone) AS is_gone FROM cells WHERE v <> '' OR cell = ''),
    agg AS (SELECT _row_number, c, any_value(cell) AS cell, count(*) AS n, count(*) FILTER (WHERE NOT is_gone) AS m,
      string_agg(v, ', ' ORDER BY i) FILTER (WHERE NOT is_gone) AS left_ FROM marked GROUP BY 1, 2)
    SELECT _row_number, {_cell_sql('basis')}, {_cell_sql('guided_by')}, {_cell_sql('amends')} FROM agg
    WHERE _row_number NOT IN (SELECT _row_number FROM register WHERE number IN (SELECT number FROM gone)) GROUP BY _row_number"""
)
def expired_cascade(spark, folder):
    return G.expired_cascade(register(spark, folder), _expired(spark, folder)).select("_row_number", "basis", "guided_by", "amends")


def _clauses(spark, folder):
    """Document texts with a closing section made of the row's own values."""
    k, n = F.col("doc_id"), F.col("n_chars")
    old, other, text = number_of(k), number_of(n), lambda c: c.cast("string")
    date = F.concat(F.lpad(text(k % 28 + 1), 2, "0"), F.lit("/"), text(k % 12 + 1), F.lit("/"), text(2020 + n % 8))
    how = F.when(k % 4 == 0, " hết hiệu lực").when(k % 4 == 1, " bị bãi bỏ một phần").when(k % 4 == 2, " được thay thế bởi văn bản này").otherwise(" được công bố")
    clause = F.concat(
        F.lit("</p> <b>Điều khoản</b>  thi hành: Văn bản này có hiệu lực. Kể từ ngày "), F.when(k % 5 == 0, "ký").otherwise(date), F.lit(", Thông tư số "), old,
        how, F.lit(" cùng "), other, F.lit("; hết hạn. Điều 7 Văn bản 99/1999/TT-BTC hết hiệu lực."),
    )
    return table(spark, folder, "documents").select(
        F.when(k % 9 == 0, F.upper(old)).otherwise(F.concat(text(k), F.lit("/2024/TT-BTC"))).alias("number"), F.concat(F.lit("D"), text(k)).alias("title"),
        F.lit("http://x").alias("url"), F.concat(F.lit("<p>"), F.lower("text"), clause).alias("html"),
        F.when(n % 50 == 0, "HTTP 500").otherwise("").alias("fetch_error"),
    )


_SCAN = f"""base AS (SELECT doc_id AS k, n_chars AS n, {sql_number('doc_id')} AS old, {sql_number('n_chars')} AS other, 'D' || doc_id AS new_title,
    CASE WHEN doc_id % 9 = 0 THEN {sql_number('doc_id')} ELSE doc_id || '/2024/TT-BTC' END AS new_number,
    lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') || '/' || (doc_id % 12 + 1) || '/' || (2020 + n_chars % 8) AS d,
    CASE doc_id % 4 WHEN 0 THEN 'hết hiệu lực' WHEN 1 THEN 'bị bãi bỏ' WHEN 2 THEN 'được thay thế bởi' END AS reason, doc_id % 4 = 1 AS is_partial FROM documents),
  cited AS (SELECT *, unnest([old, other]) AS old_number FROM base WHERE n % 50 <> 0 AND reason IS NOT NULL),
  scan AS (SELECT old_number, new_number, new_title, reason, CASE WHEN k % 5 = 0 THEN '' ELSE d END AS applied_date,
     CASE WHEN is_partial THEN 'Cần kiểm tra thủ công' WHEN k % 5 = 0 THEN 'Cần kiểm tra thủ công (Không rõ ngày)'
       WHEN make_date(2020 + n % 8, k % 12 + 1, k % 28 + 1) > DATE '2024-01-01' THEN 'Chưa xóa - chưa đến ngày hết hiệu lực' ELSE 'Chờ xóa tự động' END AS status, is_partial
   FROM cited WHERE lower(old_number) <> lower(new_number)
   UNION ALL SELECT '', new_number, new_title, 'Lỗi tải link', '', 'Thất bại - Cần check tay', false FROM base WHERE n % 50 = 0)"""


def _scan(spark, folder):
    return E.scan_expired(_clauses(spark, folder), F.lit(dt.date(2024, 1, 1)))


@query(f"WITH {_SCAN} SELECT * FROM scan")
def expired_scan(spark, folder):
    return _scan(spark, folder).select("old_number", "new_number", "new_title", "reason", "applied_date", "status", "is_partial")


@query(
    f"""WITH {_SCAN} SELECT '2024-01-01' AS detected_at, old_number, '' AS old_title, new_number, new_title, reason, applied_date, status, CASE WHEN is_partial THEN '{L.EXPIRY_YES}' ELSE '{L.EXPIRY_NO}' END AS is_partial,
      'TRUE' AS dry_run, '' AS deleted_at, '' AS row_json, '{L.EXPIRY_NOTE}' AS note FROM scan"""
)
def expiry_log(spark, folder):
    """The scan in the columns of the log, but the sentence."""
    return E.expiry_log_rows(_scan(spark, folder), F.lit("2024-01-01")).drop("sentence")


@query(
    f"""WITH {_SCAN} SELECT old_number, count(*) AS log_rows FROM scan WHERE old_number <> '' AND status IN ('Chờ xóa tự động', 'Chưa xóa - chưa đến ngày hết hiệu lực')
      AND (applied_date = '' OR strptime(nullif(applied_date, ''), '%d/%m/%Y') <= TIMESTAMP '2025-01-01') GROUP BY 1"""
)
def expiry_due(spark, folder):
    return E.expiry_due(_scan(spark, folder), F.lit(dt.date(2025, 1, 1)))


_DUE = "status IN ('Chờ xóa tự động', 'Chưa xóa - chưa đến ngày hết hiệu lực') AND (applied_date = '' OR strptime(nullif(applied_date, ''), '%d/%m/%Y') <= TIMESTAMP '2025-01-01')"


@query(
    f"""WITH {_SCAN} SELECT old_number, new_number, CASE WHEN {_DUE} THEN 'Đã mô phỏng xóa (DRY_RUN)' ELSE status END AS status,
      CASE WHEN {_DUE} THEN '02/01/2025 06:00:00' ELSE '' END AS deleted_at FROM scan"""
)
def retire_log(spark, folder):
    log = _scan(spark, folder).withColumns({"deleted_at": F.lit(""), "log_id": F.xxhash64("new_number", "old_number")})
    _, new_log = G.retire_expired(register(spark, folder), log, F.lit(dt.date(2025, 1, 1)), F.lit("02/01/2025 06:00:00"))
    return new_log.select("old_number", "new_number", "status", "deleted_at")


@query(
    f"""{WITH}, {_SCAN}, due AS (SELECT DISTINCT lower(old_number) AS o FROM scan WHERE old_number <> '' AND {_DUE}) SELECT _row_number, number FROM register WHERE lower(number) NOT IN (SELECT o FROM due)"""
)
def retire_register(spark, folder):
    log = _scan(spark, folder).withColumns({"deleted_at": F.lit(""), "log_id": F.xxhash64("new_number", "old_number")})
    new, _ = G.retire_expired(register(spark, folder), log, F.lit(dt.date(2025, 1, 1)), F.lit("x"), dry_run=False)
    return new.select("_row_number", "number")


# --- tasks ------------------------------------------------------------------------------------
TASKS = f"WITH {SQL_TASKS}"


def _register_tasks(spark, folder):
    """Orders with the columns the task loop reads."""
    k = F.col("_row_number") - 2
    return tasks(spark, folder).withColumns({
        "status_date": F.when(k % 4 == 0, "").when(k % 4 == 1, "not a date").otherwise(F.substring("last_sync", 1, 10)),
        "scanned_at": F.when(k % 8 == 0, F.concat(F.substring("last_sync", 7, 4), F.lit("-01-02"))).otherwise(F.lit("")),
        "last_sync": F.when(k % 4 == 1, F.lit("?")).when(k % 8 == 4, F.lit("")).otherwise(F.col("last_sync")),
        "process_status": F.when(k % 2 == 0, "ĐÃ CHUYỂN hồ sơ").otherwise("khác"), "approval_status": F.when(k % 3 == 0, L.CHECKED).otherwise(L.WAITING_CHECK),
    })


_CANDIDATE = """cand AS (SELECT *, CASE WHEN k % 4 = 1 OR k % 8 = 4 THEN NULL WHEN k % 8 = 0 THEN make_date(year(due - (k % 3 = 2)::INT), 1, 2) ELSE due - (k % 3 = 2)::INT END AS rec, k % 4 = 1 AS bad FROM tasks),
 reasons AS (SELECT *, CASE WHEN task_id <> '' THEN 'already has Planner Task ID' WHEN rec IS NULL THEN 'không xác định được ngày của record'
   WHEN rec < DATE '1998-06-01' THEN 'ngày record ' || strftime(rec, '%Y-%m-%d') || ' < PLANNER_CREATE_FROM_DATE 1998-06-01' ELSE '' END AS reason FROM cand)"""


@query(f"{TASKS}, {_CANDIDATE} SELECT _row_number, reason FROM reasons")
def candidate_reasons(spark, folder):
    return _register_tasks(spark, folder).select("_row_number", K.candidate_reason(as_of()).alias("reason"))


@query(
    f"""{TASKS}, {_CANDIDATE} SELECT category, count(*) AS n FROM (SELECT CASE WHEN reason = '' THEN 'candidate' WHEN reason LIKE 'already%' THEN CASE WHEN sync_status = 'Đã xóa task Planner' THEN 'deleted_planner_task' ELSE 'has_planner_task_id' END
      WHEN reason LIKE 'ngày%' THEN 'before_create_from_date' WHEN bad THEN 'invalid_create_date' ELSE 'missing_create_date' END AS category FROM reasons) GROUP BY 1"""
)
def skip_categories(spark, folder):
    rows = _register_tasks(spark, folder).withColumn("reason", K.candidate_reason(as_of()))
    category = F.when(F.col("reason") == "", "candidate").otherwise(K.skip_category())
    return rows.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""{TASKS}, {_CANDIDATE} SELECT CASE WHEN rec IS NOT NULL THEN 'ok' WHEN bad THEN 'invalid' ELSE 'missing' END AS state, coalesce(strftime(rec, '%Y-%m'), '') AS month,
      (k % 2 = 0 OR k % 3 = 0) AS eligible, count(*) AS n FROM cand GROUP BY 1, 2, 3"""
)
def record_dates(spark, folder):
    rows = _register_tasks(spark, folder).select(K.record_date().alias("d"), K.is_eligible().alias("eligible"))
    month = F.coalesce(F.date_format("d.day", "yyyy-MM"), F.lit(""))
    return rows.groupBy(F.col("d.state").alias("state"), month.alias("month"), "eligible").agg(F.count(F.lit(1)).alias("n"))


@query(f"{TASKS}, {_CANDIDATE} SELECT _row_number FROM reasons WHERE reason = '' ORDER BY _row_number LIMIT 40")
def limited_candidates(spark, folder):
    return K.candidates(_register_tasks(spark, folder), as_of(), limit=40).select("_row_number")


@query(f"{TASKS} SELECT _row_number, task_id FROM tasks WHERE task_id <> '' AND sync_status <> 'Đã xóa task Planner'")
def sync_back(spark, folder):
    return tasks(spark, folder).filter(K.sync_back_filter()).select("_row_number", "task_id")


@query(
    f"""{WITH} SELECT _row_number, CASE WHEN length('[' || number || '] ' || t) > 255 THEN '[' || number || '] ' || substr(t, 1, 254 - length('[' || number || '] ')) || '…' ELSE '[' || number || '] ' || t END AS task_title,
      'Số hiệu: ' || number || e'\\nTên văn bản: ' || t || e'\\nLoại văn bản: ' || doc_type || e'\\nNgày hiệu lực: ' || effective_date AS description,
      'Pháp chế | a@example.org | Hạn hoàn thành: 08/06/1998 | Phân tích sơ bộ' AS checklist_title, true AS checklist_ok,
      replace(replace(replace(replace(replace(url, '%', '%25'), '.', '%2E'), ':', '%3A'), '@', '%40'), '#', '%23') AS reference_key,
      CASE WHEN length(t) > 100 THEN rtrim(substr(t, 1, 97)) || '...' ELSE t END AS reference_alias, true AS reference_ok, '08/06/1998' AS next_due
    FROM (SELECT *, repeat(title || ' ', p_size) || 'hết' AS t FROM register)"""
)
def task_outbox(spark, folder):
    sized = register(spark, folder).join(table(spark, folder, "part").select((F.col("p_partkey") + 2).alias("_row_number"), "p_size"), "_row_number")
    long = sized.withColumn("title", F.concat(F.expr("repeat(concat(title, ' '), p_size)"), F.lit("hết")))
    return K.task_outbox(long, "Pháp chế", "a@example.org", D.next_due(as_of(), 7))


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT10:00:00Z') AS due_utc, strftime(CAST(o_orderdate AS DATE) + 1, '%d/%m/%Y') AS shifted,
      strftime(o_orderdate, '%d/%m/%Y') AS flexible, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE 'khi có hướng dẫn' END AS shown FROM orders"""
)
def due_dates(spark, folder):
    day = F.date_format("o_orderdate", "d/M/yyyy")
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T18:30:00+00:00"))
    return table(spark, folder, "orders").select(
        "o_orderkey", D.due_utc(day).alias("due_utc"), D.format_day(D.parse_date_value(iso)).alias("shifted"), D.format_day(D.parse_date_flexible(iso)).alias("flexible"),
        D.format_effective_date(F.when(F.col("o_orderkey") % 2 == 0, day).otherwise("khi có hướng dẫn")).alias("shown"),
    )


@query(
    """SELECT o_orderkey, 'https://t.example.org/plan-1/T' || o_orderkey AS task_url, u.user_id, u.email, u.department FROM orders,
      (VALUES ('a', 'a@x', 'PC'), ('b', 'b@x', 'KT')) u(user_id, email, department)"""
)
def task_assignees(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", X.task_url("https://t.example.org/{plan_id}/{task_id}", F.concat(F.lit("T"), F.col("o_orderkey").cast("string")), {"plan_id": "plan-1"}).alias("task_url"),
        X.assignees(F.lit("a; b"), F.lit("a@x,b@x"), F.lit("PC  KT")).alias("a"),
    )
    return rows.select("o_orderkey", "task_url", F.inline("a"))


def _checklist(spark, folder):
    """Turns of a conversation as checklist entries of a task; system turns do not parse."""
    role, turn = F.col("role"), F.col("turn")
    title = F.when(role == "system", "ghi chú | x").otherwise(
        F.concat(F.when(turn % 2 == 0, "").otherwise("PC"), F.lit(" | u"), turn.cast("string"), F.lit("@x | Hạn hoàn thành: 0"), (turn + 1).cast("string"), F.lit("/05/2026 | Bước "), turn.cast("string"), F.lit(" | thừa"))
    )
    return table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("task_id"), title.alias("title"), (role == "user").alias("is_checked"), F.lpad((9 - turn).cast("string"), 3, "0").alias("order_hint"), turn.alias("ord")
    )


_ACTIVE = """items AS (SELECT conv_id::VARCHAR AS task_id, turn, role = 'user' AS checked FROM conversations WHERE role <> 'system'),
 active AS (SELECT task_id, coalesce(max(turn) FILTER (WHERE NOT checked), min(turn)) AS t, bool_and(checked) AS all_checked FROM items GROUP BY task_id)"""


@query(
    f"""WITH {_ACTIVE} SELECT task_id, CASE WHEN t % 2 = 0 THEN '' ELSE 'PC' END AS department, 'u' || t || '@x' AS pic, '0' || (t + 1) || '/05/2026' AS due_text, 'Bước ' || t AS step, all_checked FROM active"""
)
def active_items(spark, folder):
    return K.active_items(_checklist(spark, folder), ["task_id"]).select("task_id", "item.*", "all_checked")


def _state(spark, folder):
    rows = table(spark, folder, "orders").select(
        (F.col("o_orderkey") + 2).alias("_row_number"), (F.col("o_orderkey") % 700).cast("string").alias("task_id"), F.when(F.col("o_orderstatus") == "O", L.TASK_DELETED).otherwise("").alias("sync_status"),
        F.lit("").alias("last_sync"),
    )
    heads = table(spark, folder, "conversations").groupBy(F.col("conv_id").cast("string").alias("task_id")).agg((F.max("turn") * 20).cast("int").alias("percent_complete"))
    return rows, heads, K.active_items(_checklist(spark, folder), ["task_id"])


_STATE = f"""{_ACTIVE}, heads AS (SELECT conv_id::VARCHAR AS task_id, max(turn) * 20 AS pc FROM conversations GROUP BY 1),
 rows_ AS (SELECT o_orderkey + 2 AS _row_number, (o_orderkey % 700)::VARCHAR AS task_id, o_orderstatus FROM orders),
 joined AS (SELECT r.*, h.pc, a.t, a.all_checked FROM rows_ r LEFT JOIN heads h USING (task_id) LEFT JOIN active a USING (task_id))"""


@query(
    f"""WITH {_STATE} SELECT _row_number, CASE WHEN pc IS NULL THEN 'deleted' ELSE 'updated' END AS outcome,
      CASE WHEN pc IS NULL THEN 'Đã xóa task Planner' WHEN pc = 100 THEN 'Đã hoàn thành task' WHEN t IS NULL OR NOT all_checked THEN 'Đang chờ PIC xử lý' ELSE 'Đã hoàn thành checkpoint' END AS sync_status,
      CASE WHEN pc IS NULL OR pc = 100 OR t IS NULL THEN NULL WHEN t % 2 = 0 THEN 'u' || t || '@x' ELSE 'PC | u' || t || '@x' END AS current_pic,
      CASE WHEN pc IS NULL THEN NULL WHEN pc = 100 THEN 'Đã hoàn thành toàn bộ' WHEN t IS NULL THEN NULL WHEN all_checked THEN 'Đã hoàn thành: Bước ' || t ELSE 'Bước ' || t END AS current_checkpoint
    FROM joined WHERE o_orderstatus <> 'O'"""
)
def task_state(spark, folder):
    rows, heads, active = _state(spark, folder)
    state = K.task_state_join(rows, heads, active, F.lit("now"))
    return state.select("_row_number", "outcome", "updates.sync_status", "updates.current_pic", "updates.current_checkpoint")


@query(
    "WITH t AS (" + CHECKS["task_state"] + """)
    SELECT _row_number AS row_number, c AS "column", v AS value FROM (SELECT _row_number, unnest(['sync_status', 'current_pic', 'current_checkpoint']) AS c,
      unnest([sync_status, current_pic, current_checkpoint]) AS v FROM t) WHERE v IS NOT NULL"""
)
def state_updates(spark, folder):
    """The task states as cell updates; sync time and due date are left to ``task_state``'s own tests."""
    rows, heads, active = _state(spark, folder)
    cells = K.update_rows(K.task_state_join(rows, heads, active, F.lit("now")))
    return cells.filter(~F.col("column").isin("last_sync", "next_due")).select("row_number", "column", "value")


@query(f"""WITH {_STATE} SELECT _row_number, CASE WHEN o_orderstatus = 'O' OR pc IS NULL THEN 'Đã xóa task Planner' ELSE '' END AS sync_status, CASE WHEN o_orderstatus <> 'O' AND pc IS NULL THEN 'now' ELSE '' END AS last_sync FROM joined""")
def deleted_tasks(spark, folder):
    rows, heads, _ = _state(spark, folder)
    return K.mark_deleted_tasks(rows, heads, F.lit("now")).select("_row_number", "sync_status", "last_sync")


@query(
    f"""WITH {_STATE} SELECT count(*) AS total_records, count(*) FILTER (WHERE o_orderstatus = 'O') AS skipped_records, count(*) FILTER (WHERE o_orderstatus <> 'O') AS candidate_records,
      count(*) FILTER (WHERE o_orderstatus <> 'O') AS records_to_process, count(*) FILTER (WHERE o_orderstatus <> 'O' AND pc IS NOT NULL) AS created_tasks,
      count(*) FILTER (WHERE o_orderstatus <> 'O' AND pc IS NULL) AS failed_records, count(*) FILTER (WHERE o_orderstatus <> 'O' AND pc IS NULL) = 0 AS ok FROM joined"""
)
def run_summary(spark, folder):
    rows, heads, _ = _state(spark, folder)
    known = heads.select("task_id", F.lit(True).alias("found"))
    outcome = F.when(F.col("sync_status") != "", "skipped").when(F.col("found"), "created").otherwise("failed")
    return K.run_summary(rows.join(known, "task_id", "left").withColumn("outcome", outcome))


@query(
    f"""{TASKS} SELECT _row_number, 'new-' || k AS task_id, 'P1' AS plan_id, 'B1' AS bucket_id, 'Pháp chế' AS bucket_name, 'u' AS task_url, 'Đã tạo task Planner' AS sync_status, 'now' AS last_sync,
      'a@x,b@x' AS current_pic, 'Phân tích sơ bộ' AS current_checkpoint, '08/06/1998' AS next_due FROM tasks WHERE task_id = ''"""
)
def initial_columns(spark, folder):
    rows = tasks(spark, folder).filter("task_id = ''").withColumns({
        "new_task_id": F.concat(F.lit("new-"), (F.col("_row_number") - 2).cast("string")), "new_task_url": F.lit("u"), "new_due": D.format_day(D.next_due(as_of(), 7)),
    })
    done = K.initial_columns(rows, "P1", "B1", "a@x,b@x", F.lit("now"))
    return done.select("_row_number", "task_id", "plan_id", "bucket_id", "bucket_name", "task_url", "sync_status", "last_sync", "current_pic", "current_checkpoint", "next_due")


# --- validation -------------------------------------------------------------------------------
def _results(spark, folder):
    """Orders as submission results; the answer is JSON text."""
    k = F.col("o_orderkey")
    answer = (
        F.when(k % 7 == 0, '{"ok": false, "error": "x"}')
        .when(k % 7 == 1, '{"ok": true, "result": {"write_result": {"action": "skipped"}}}')
        .when(k % 7 == 2, '{"ok": true, "result": {"write_result": {"action": "updated"}}}')
        .when(k % 7 == 3, "not json")
        .otherwise(F.concat(
            F.lit('{"ok": true, "result": {"write_result": {"action": "inserted"}, "match_report": {"A": {"matched_ids": ["1"], "missing_items": ['),
            F.when(k % 7 == 4, '{"so_hieu_tu_luoc_do": "1/2020/TT-X"}, {"so_hieu_tu_luoc_do": "2/2020/TT-X"}').otherwise(""), F.lit(']}, "B": {"missing_items": []}}}}'),
        ))
    )
    status = F.when(F.col("o_orderstatus") == "F", "sent").when(F.col("o_orderpriority") == "1-URGENT", "error").when(F.col("o_orderpriority") == "2-HIGH", "dry_run").when(
        F.col("o_orderpriority") == "5-LOW", "").otherwise("sent")
    return table(spark, folder, "orders").select(k.alias("ord"), status.alias("status"), answer.alias("result"))


_RESULTS = """res AS (SELECT o_orderkey AS ord, o_orderkey % 7 AS m, CASE WHEN o_orderstatus = 'F' THEN 'sent' WHEN o_orderpriority = '1-URGENT' THEN 'error' WHEN o_orderpriority = '2-HIGH' THEN 'dry_run' WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'sent' END AS status FROM orders),
 outc AS (SELECT ord, CASE WHEN status = 'sent' THEN CASE WHEN m IN (0, 3) THEN 'not_ok' WHEN m = 1 THEN 'write_skipped' WHEN m = 2 THEN 'no_match_report' WHEN m = 4 THEN 'relations_missing' ELSE 'success' END
    WHEN status = 'error' THEN 'status_error' WHEN status = 'dry_run' THEN 'unexpected_dry_run' ELSE 'unknown_status' END AS outcome, CASE WHEN status = 'sent' AND m = 4 THEN 2 ELSE 0 END AS missing_relations FROM res),
 sev AS (SELECT *, CASE WHEN outcome IN ('not_ok', 'write_skipped', 'status_error', 'unexpected_dry_run') THEN 'error' WHEN outcome IN ('no_match_report', 'unknown_status') THEN 'warning' ELSE 'none' END AS severity FROM outc)"""
_RESULT_COUNTS = """count(*) AS results, count(*) FILTER (WHERE severity = 'error') AS result_errors, count(*) FILTER (WHERE severity = 'warning') AS result_warnings,
  count(*) FILTER (WHERE outcome IN ('success', 'relations_missing', 'no_match_report')) AS sent_success, count(*) FILTER (WHERE outcome = 'not_ok') AS sent_not_ok,
  count(*) FILTER (WHERE outcome = 'write_skipped') AS sent_skipped, count(*) FILTER (WHERE outcome = 'no_match_report') AS sent_without_report, count(*) FILTER (WHERE missing_relations > 0) AS relation_missing_documents"""


@query(f"WITH {_RESULTS} SELECT ord, outcome, severity, missing_relations FROM sev")
def result_outcomes(spark, folder):
    return V.result_outcome(_results(spark, folder)).select("ord", "outcome", "severity", "missing_relations")


@query(f"WITH {_RESULTS} SELECT {_RESULT_COUNTS} FROM sev")
def result_counts(spark, folder):
    return V.result_counts(V.result_outcome(_results(spark, folder)))


@query(
    f"""WITH {_RESULTS}, c AS (SELECT {_RESULT_COUNTS} FROM sev) SELECT false AS ok, 'result_errors:' || result_errors || '|sent_not_ok:' || sent_not_ok || '|sent_skipped:' || sent_skipped || '|sent_without_report:' || sent_without_report AS errors,
      'relation_missing_documents:' || relation_missing_documents || '|result_warnings:' || result_warnings AS warnings FROM c"""
)
def run_verdict(spark, folder):
    counts = V.result_counts(V.result_outcome(_results(spark, folder)))
    zero = F.lit(0)
    summary = counts.withColumns({"config_errors": zero, "documents": F.col("results"), "invalid_documents": zero, "invalid_payloads": zero, "warned_documents": zero})
    return V.run_verdict(summary).select("ok", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"))


@query(
    f"""WITH {_RESULTS} SELECT outcome AS section, ord FROM (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY ord) AS rn FROM sev)
      WHERE outcome NOT IN ('not_ok', 'no_match_report') OR rn <= CASE outcome WHEN 'not_ok' THEN 40 ELSE 30 END"""
)
def capped_report(spark, folder):
    lines = V.result_outcome(_results(spark, folder)).select(F.col("outcome").alias("section"), "ord")
    return V.capped_sections(lines, "section", ["ord"], {"not_ok": 40, "no_match_report": 30})


@query(
    """SELECT o_orderkey, 'n' || o_custkey AS number, 0 AS ord FROM orders UNION ALL SELECT o_orderkey, 's' || o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 1 END FROM orders"""
)
def unwrapped_records(spark, folder):
    """Every order as an API answer in one of four envelopes."""
    k = F.col("o_orderkey")
    first, second = F.concat(F.lit('{"number":"n'), F.col("o_custkey").cast("string"), F.lit('"}')), F.concat(F.lit('{"number":"s'), F.col("o_orderstatus"), F.lit('"}'))
    rows = F.concat(F.lit("["), first, F.when(k % 4 == 0, ", 17").otherwise(""), F.lit(", "), second, F.lit("]"))
    answer = (
        F.when(k % 4 == 0, rows).when(k % 4 == 1, F.concat(F.lit('{"ok":true,"data":'), rows, F.lit("}")))
        .when(k % 4 == 2, F.concat(F.lit('{"data":"x","result":'), rows, F.lit("}"))).otherwise(F.concat(F.lit('{"result":{"data":'), rows, F.lit("}}")))
    )
    unwrapped = J.unwrap_records(table(spark, folder, "orders").select("o_orderkey", answer.alias("body")), "body", ["o_orderkey"])
    return unwrapped.select("o_orderkey", F.get_json_object("record", "$.number").alias("number"), F.col("ord").cast("int").alias("ord"))


@query(
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN '{"so_hieu":"' || user_id || '"' || CASE WHEN event_type = 'click' THEN ',"dry_run":"true"' ELSE '' END || '}' END AS body,
      coalesce(regexp_extract(props, '[0-9]+'), '') AS k, 'none' AS absent FROM events"""
)
def request_bodies(spark, folder):
    path = F.when(F.col("event_type") == "click", "/sync-webapp-to-planner").when(F.col("event_type") == "view", "/delete-planner-task").otherwise("/other")
    body = F.concat(F.lit('{"so_hieu":"'), F.col("user_id").cast("string"), F.lit('","dry_run":true,"secret":"x"}'))
    return table(spark, folder, "events").select(
        "event_id", J.keep_path_keys(path, body).alias("body"), J.json_path("props", "$.k", "").alias("k"), J.json_path("props", "$.a.b", "none").alias("absent")
    )


# --- requests ---------------------------------------------------------------------------------
def _requests(spark, folder):
    """Events as signed requests: one id per user and event type, late or early by event id."""
    k = F.col("event_id")
    sent = F.unix_seconds(F.date_trunc("second", "ts").cast("timestamp"))
    arrival = sent + F.when(k % 7 == 0, 400).when(k % 11 == 0, -45).otherwise(k % 5)
    stamp = F.when(k % 13 == 0, "soon").when(k % 17 == 0, "").otherwise(sent.cast("string"))
    return table(spark, folder, "events").select(
        k.alias("ord"), F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("request_id"), arrival.cast("long").alias("arrival_s"), stamp.alias("raw_timestamp"),
        F.when(k % 19 == 0, F.repeat(F.lit("x"), F.lit(300))).otherwise(F.lit("x")).alias("body"),
    )


_REQUESTS = """req AS (SELECT event_id AS ord, user_id || '-' || event_type AS request_id, event_id AS k, epoch(date_trunc('second', ts))::BIGINT AS sent FROM events),
 arr AS (SELECT *, sent + CASE WHEN k % 7 = 0 THEN 400 WHEN k % 11 = 0 THEN -45 ELSE k % 5 END AS arrival_s FROM req),
 fixed AS (SELECT *, CASE WHEN k % 19 = 0 THEN 'BODY_TOO_LARGE' WHEN k % 17 = 0 AND k % 13 <> 0 THEN 'MISSING_SIGNATURE_HEADERS' WHEN k % 13 = 0 THEN 'INVALID_TIMESTAMP'
   WHEN k % 7 = 0 THEN 'TIMESTAMP_EXPIRED' WHEN k % 11 = 0 THEN 'TIMESTAMP_FUTURE' ELSE '' END AS fault FROM arr),
 valid AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY arrival_s, ord) AS rn FROM fixed WHERE fault = ''),
 chain AS (SELECT request_id, rn, ord, arrival_s AS last_taken, true AS taken FROM valid WHERE rn = 1
   UNION ALL SELECT v.request_id, v.rn, v.ord, CASE WHEN v.arrival_s - c.last_taken > 86400 THEN v.arrival_s ELSE c.last_taken END, v.arrival_s - c.last_taken > 86400
   FROM chain c JOIN valid v ON v.request_id = c.request_id AND v.rn = c.rn + 1)"""


@query(f"""WITH RECURSIVE {_REQUESTS} SELECT f.ord, f.request_id, CASE WHEN fault <> '' THEN fault WHEN taken THEN '' ELSE 'REPLAY_DETECTED' END AS code FROM fixed f LEFT JOIN chain USING (ord)""")
def request_audit(spark, folder):
    """Ids may be used again after a day."""
    return audit(_requests(spark, folder), 300, 30, 200, replay_ttl=86400).select("ord", "request_id", "code")


@query(f"""WITH RECURSIVE {_REQUESTS.replace('86400', '300')} SELECT code, count(*) AS n FROM (SELECT CASE WHEN fault <> '' THEN fault WHEN taken THEN '' ELSE 'REPLAY_DETECTED' END AS code FROM fixed LEFT JOIN chain USING (ord)) GROUP BY 1""")
def request_codes(spark, folder):
    return audit(_requests(spark, folder), 300, 30, 200).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE {_REQUESTS} SELECT request_id, ord FROM chain WHERE taken""")
def replay_filter(spark, folder):
    valid = _requests(spark, folder).filter(static_code(300, 30, 200) == "")
    return accepted_sights(valid, 86400).select("request_id", "ord")


@query("""SELECT DISTINCT 'T-' || user_id AS task_id, strftime(ts, '%Y-%m-%d') AS sent_date FROM events""")
def daily_once(spark, folder):
    alerts = table(spark, folder, "events").select(F.concat(F.lit("T-"), F.col("user_id").cast("string")).alias("task_id"), "ts")
    sent = once_a_day(alerts, "ts", spark.conf.get("spark.sql.session.timeZone"))
    return sent.select("task_id", F.date_format("sent_date", "yyyy-MM-dd").alias("sent_date"))
