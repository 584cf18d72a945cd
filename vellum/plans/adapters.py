"""The given tables as register-shaped frames, and the same derivations as SQL.

Derived values are plain arithmetic and text of the row's own columns, so that every row
of a table takes part and both engines can state them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.html import html_links, page_title
from vellum.sources.config import RuleSet

AS_OF = dt.date(1998, 6, 1)
SUFFIXES = ["TT-BGDĐT", "NĐ-CP", "QH15", "TT-BTC"]
EDGE_HEADINGS = [
    "Văn bản căn cứ",
    "Văn bản được hướng dẫn",
    "Văn bản bị sửa đổi, bổ sung",
    "Văn bản sửa đổi, bổ sung",
    "Văn bản hướng dẫn",
    "Văn bản thay thế",
    "Văn bản liên quan",
]
LISTING_TYPES = ["Thông tư", "Nghị định", "Luật", "Bộ luật", "Quyết định", ""]
LISTING_RULES = RuleSet(
    accepted_doc_types=["Thông tư", "Nghị định", "Luật", "Bộ luật"],
    required_paths=["/en/", "fr", "de"],
    excluded_paths=["/es/"],
    skip_doc_types=["Quyết định"],
    title_keywords=["ANDE", "QUE"],
    url_keywords=["spam-farm", "cheap-pills"],
    number_keywords=["/QH1"],
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The same rows dealt to all cores: a file of few bytes a row is read by few tasks, however much
    work its rows are."""
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks)


def as_of() -> Column:
    return F.lit(AS_OF)


def pick(values: list[str], index: Column) -> Column:
    """Entry of a short list by a 0-based index taken modulo its length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def number_of(key: Column) -> Column:
    k = key.cast("long")
    return F.concat(k.cast("string"), F.lit("/"), (F.lit(2000) + k % 25).cast("string"), F.lit("/"), pick(SUFFIXES, k))


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as task rows.  Both sides come straight from scans, so Spark's own skew
    handling splits a customer with very many orders."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customers.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    user = F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@example.org"))
    cell = F.concat(F.col("c_mktsegment"), F.lit(" | "), user)
    checklist = F.concat(
        cell, F.lit(" | Hạn hoàn thành: "), F.date_format(day, "d/M/yyyy"), F.lit(" | Bước "), F.col("o_orderpriority"), F.lit(" | kiểm tra")
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", F.when(k % 2 == 0, L.CHECKPOINT_DONE).otherwise(L.TASK_DONE))
        .when(F.col("o_orderstatus") == "P", L.TASK_WAITING)
        .when(F.col("o_orderpriority") == "1-URGENT", L.TASK_DELETED)
        .otherwise("")
    )
    return joined.select(
        (k + 2).alias("_row_number"),
        number_of(k).alias("number"),
        F.concat(F.lit("Văn bản <"), F.col("o_orderpriority"), F.lit("> & số "), k.cast("string"), F.lit(" của một danh mục có tên rất dài")).alias("title"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O"), "").otherwise(F.concat(F.lit("T-"), k.cast("string"))).alias("task_id"),
        F.concat(F.lit("https://tasks.example.org/t/"), k.cast("string")).alias("task_url"),
        status.alias("sync_status"),
        F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" 08:00:00")).alias("last_sync"),
        F.when(k % 5 == 0, user).otherwise(cell).alias("current_pic"),
        F.when(k % 3 == 0, checklist).otherwise(F.lit(L.FIRST_STEP)).alias("current_checkpoint"),
        F.when(k % 3 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(k % 3 == 2, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T17:00:00.000Z")))
        .otherwise("")
        .alias("next_due"),
    )


def register(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as register rows; one type has no id yet, so references to it are missing."""
    p = F.col("p_partkey")
    text = lambda c: F.col(c).cast("string")
    day = F.concat(F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"), F.lit("/0"), (p % 9 + 1).cast("string"), F.lit("/2023"))
    return table(spark, folder, "part").select(
        (p + 2).alias("_row_number"),
        F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.concat(F.lit("VB"), text("p_partkey"))).alias("id"),
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_type")).alias("field"),
        F.lit("").alias("topic"),
        F.lit("").alias("section"),
        pick(LISTING_TYPES, F.col("p_size")).alias("doc_type"),
        F.concat(F.lit("Thông tư về "), F.col("p_name")).alias("title"),
        number_of(p).alias("number"),
        day.alias("effective_date"),
        F.when(F.col("p_retailprice") > 1000, "Cao").otherwise("").alias("impact"),
        F.col("p_brand").alias("department"),
        F.concat(F.lit("https://register.example.org/giao-duc/"), F.lower("p_type"), F.lit("-"), text("p_partkey"), F.lit("-d1.html")).alias("url"),
        F.concat(number_of(F.col("p_size")), F.lit(", "), number_of(F.col("p_size") * 2), F.lit(";\n "), number_of(p)).alias("basis"),
        F.when(p % 3 == 0, number_of(F.col("p_size") + 1)).otherwise(F.lit("")).alias("guided_by"),
        F.when(p % 4 == 0, F.concat(number_of(p + 1), F.lit("\n"), number_of(p + 2))).otherwise(F.lit("")).alias("amends"),
        F.lit("").alias("amended_by"),
        pick([L.WAITING_CHECK, L.IRRELEVANT, L.CHECKED], F.col("p_size")).alias("approval_status"),
        F.when(F.col("p_type") == "PROMO", L.TRANSFERRED).otherwise(L.WAITING_AUTO_CHECK).alias("process_status"),
        F.when(p % 7 == 0, "").otherwise(F.concat(day, F.lit(" 10:30:00"))).alias("status_date"),
    )


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as document-to-document references, spelled in three ways."""
    p, line = F.col("l_partkey"), F.col("l_linenumber")
    number = number_of(p)
    spelled = (
        F.when(F.col("l_returnflag") == "A", number)
        .when(F.col("l_returnflag") == "N", F.lower(F.replace(number, F.lit("/"), F.lit(" / "))))
        .otherwise(F.replace(F.replace(number, F.lit("Đ"), F.lit("D")), F.lit("-"), F.lit("–")))
    )
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("doc"),
        number_of(F.col("l_orderkey")).alias("src_number"),
        pick(EDGE_HEADINGS, line - 1).alias("heading"),
        spelled.alias("ref_number"),
        F.concat(F.lit("Văn bản số "), number, F.lit(" ngày "), F.date_format("l_shipdate", "dd/MM/yyyy")).alias("item"),
        line.alias("l1"), p.alias("l2"), F.col("l_suppkey").alias("l3"), F.col("l_extendedprice").alias("l4"),
    )


EDGE_ORDER = ["l1", "l2", "l3", "l4"]
EDGE_SPREAD = ["doc", "l1", "l2", "l3", "l4"]


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as listing rows; the address is cut to its language part so that some repeat."""
    k = F.col("page_id")
    kind = pick(LISTING_TYPES, F.length("html"))
    return table(spark, folder, "pages").select(
        k.alias("ord"),
        F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("field_code"),
        F.regexp_extract("url", "^(.*?/[a-z][a-z]/)", 1).alias("url"),
        F.concat(F.when(kind == "", F.lit("Luật")).otherwise(kind), F.lit(" "), page_title("html")).alias("title"),
        kind.alias("doc_type"),
        F.when(k % 10 == 0, "").otherwise(number_of(k)).alias("doc_number"),
        F.expr("page_id div 20 + 1").alias("page_index"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(k % 30).cast("int").alias("row_number"),
        F.length("html").cast("double").alias("row_top"),
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    return html_links(table(spark, folder, "pages"), ["page_id"])


def page_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Links of a page as its references: heading by place, number by the length of the text."""
    n = F.length("text") * 7 + F.col("ord")
    return links(spark, folder).select(
        F.col("page_id").alias("doc"), "ord", pick(EDGE_HEADINGS, F.col("ord") - 1).alias("heading"),
        F.when(F.col("ord") % 6 == 0, "").otherwise(number_of(n)).alias("ref_number"),
        F.concat(F.col("text"), F.lit(" số "), number_of(n)).alias("item"),
    )


# --- the same in SQL ----------------------------------------------------------------------
def sql_pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[(({index}) % {len(values)} + 1)::INT]"


def sql_number(key: str) -> str:
    return f"(({key})::BIGINT::VARCHAR || '/' || (2000 + ({key}) % 25)::BIGINT::VARCHAR || '/' || {sql_pick(SUFFIXES, key)})"


def sql_match_key(text: str) -> str:
    plain = f"upper(strip_accents(replace(replace({text}, 'Đ', 'D'), 'đ', 'd')))"
    return f"regexp_replace({plain}, '[\\s.–—−-]', '', 'g')"


def sql_percent(part: str, whole: str, empty: float) -> str:
    return f"(CASE WHEN ({whole}) = 0 THEN {empty}::DOUBLE ELSE ((20000 * ({part}) + ({whole})) // (2 * ({whole})))::DOUBLE / 100.0 END)"


SQL_TASKS = f"""
tasks AS (
  SELECT o_orderkey AS k, o_orderkey + 2 AS _row_number, {sql_number('o_orderkey')} AS number,
    'Văn bản <' || o_orderpriority || '> & số ' || o_orderkey || ' của một danh mục có tên rất dài' AS title,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN '' ELSE 'T-' || o_orderkey END AS task_id,
    'https://tasks.example.org/t/' || o_orderkey AS task_url,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'Đã hoàn thành checkpoint'
         WHEN o_orderstatus = 'F' THEN 'Đã hoàn thành task'
         WHEN o_orderstatus = 'P' THEN 'Đang chờ PIC xử lý'
         WHEN o_orderpriority = '1-URGENT' THEN 'Đã xóa task Planner' ELSE '' END AS sync_status,
    strftime(o_orderdate, '%d/%m/%Y') || ' 08:00:00' AS last_sync,
    c_mktsegment AS seg, 'user' || o_custkey || '@example.org' AS usr,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Bước ' || o_orderpriority || ' | kiểm tra' ELSE 'Phân tích sơ bộ' END AS checkpoint,
    CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 3 = 2 THEN 1 ELSE 0 END AS due
  FROM orders JOIN customer ON o_custkey = c_custkey
),
enriched AS (
  SELECT *, CASE WHEN k % 3 = 0 THEN seg WHEN k % 5 = 0 THEN '' ELSE seg END AS department, usr AS pic,
    sync_status IN ('Đã hoàn thành checkpoint', 'Đã hoàn thành task') AS is_completed,
    due < DATE '1998-06-01' AND sync_status NOT IN ('Đã hoàn thành checkpoint', 'Đã hoàn thành task') AS is_overdue,
    (DATE '1998-06-01' - due)::INT AS days
  FROM tasks WHERE task_id <> '' AND sync_status <> 'Đã xóa task Planner'
),
alerts AS (
  SELECT *, CASE WHEN k % 3 = 0 THEN seg ELSE '' END AS department,
    CASE WHEN k % 3 = 0 OR k % 5 = 0 THEN usr ELSE seg || ' | ' || usr END AS pic,
    (DATE '1998-06-01' - due)::INT AS days
  FROM tasks
  WHERE task_id <> '' AND due < DATE '1998-06-01'
    AND sync_status NOT IN ('Đã hoàn thành checkpoint', 'Đã hoàn thành task', 'Đã xóa task Planner')
)"""

SQL_REGISTER = f"""
register AS (
  SELECT p_partkey AS p, p_partkey + 2 AS _row_number,
    CASE WHEN p_type = 'ECONOMY' THEN '' ELSE 'VB' || p_partkey END AS id,
    CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_type END AS field, '' AS topic, '' AS section,
    {sql_pick(LISTING_TYPES, 'p_size')} AS doc_type, 'Thông tư về ' || p_name AS title,
    {sql_number('p_partkey')} AS number,
    lpad((p_size % 28 + 1)::VARCHAR, 2, '0') || '/0' || (p_partkey % 9 + 1) || '/2023' AS effective_date,
    CASE WHEN p_retailprice > 1000 THEN 'Cao' ELSE '' END AS impact, p_brand AS department,
    'https://register.example.org/giao-duc/' || lower(p_type) || '-' || p_partkey || '-d1.html' AS url,
    {sql_number('p_size')} || ', ' || {sql_number('p_size * 2')} || e';\\n ' || {sql_number('p_partkey')} AS basis,
    CASE WHEN p_partkey % 3 = 0 THEN {sql_number('p_size + 1')} ELSE '' END AS guided_by,
    CASE WHEN p_partkey % 4 = 0 THEN {sql_number('p_partkey + 1')} || e'\\n' || {sql_number('p_partkey + 2')} ELSE '' END AS amends,
    '' AS amended_by,
    {sql_pick([L.WAITING_CHECK, L.IRRELEVANT, L.CHECKED], 'p_size')} AS approval_status,
    CASE WHEN p_type = 'PROMO' THEN 'Đã chuyển' ELSE 'Chờ kiểm tra tự động' END AS process_status,
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE lpad((p_size % 28 + 1)::VARCHAR, 2, '0') || '/0' || (p_partkey % 9 + 1) || '/2023 10:30:00' END AS status_date,
    p_type, p_size
  FROM part
)"""

SQL_EDGES = f"""
edges AS (
  SELECT l_orderkey AS doc, l_partkey AS p, {sql_number('l_orderkey')} AS src_number,
    {sql_pick(EDGE_HEADINGS, 'l_linenumber - 1')} AS heading,
    CASE l_returnflag WHEN 'A' THEN {sql_number('l_partkey')}
      WHEN 'N' THEN lower(replace({sql_number('l_partkey')}, '/', ' / '))
      ELSE replace(replace({sql_number('l_partkey')}, 'Đ', 'D'), '-', '–') END AS ref_number,
    'Văn bản số ' || {sql_number('l_partkey')} || ' ngày ' || strftime(l_shipdate, '%d/%m/%Y') AS item,
    l_linenumber AS l1, l_partkey AS l2, l_suppkey AS l3, l_extendedprice AS l4
  FROM lineitem
),
matched AS (
  SELECT e.*, r.id AS matched_id, r.number AS matched_number, r._row_number AS matched_row
  FROM edges e LEFT JOIN (SELECT * FROM register WHERE id <> '') r ON e.p = r.p
)"""

SQL_LISTING = f"""
listing AS (
  SELECT page_id AS ord, regexp_extract(url, '/([a-z][a-z])/', 1) AS field_code,
    regexp_extract(url, '^(.*?/[a-z][a-z]/)', 1) AS url,
    (CASE WHEN kind = '' THEN 'Luật' ELSE kind END) || ' ' ||
      trim(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&amp;', '&')) AS title,
    kind AS doc_type, CASE WHEN page_id % 10 = 0 THEN '' ELSE {sql_number('page_id')} END AS doc_number,
    page_id // 20 + 1 AS page_index, CASE WHEN page_id % 4 = 0 THEN NULL ELSE (page_id % 30)::INT END AS row_number,
    length(html)::DOUBLE AS row_top
  FROM (SELECT *, {sql_pick(LISTING_TYPES, 'length(html)')} AS kind FROM pages)
)"""

_ANCHOR_SQL = """(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>"""
SQL_LINKS = f"""
raw_links AS (
  SELECT page_id, url AS page_url,
    unnest(regexp_extract_all(html, '{_ANCHOR_SQL}', 1)) AS href,
    unnest(regexp_extract_all(html, '{_ANCHOR_SQL}', 2)) AS inner_html,
    generate_subscripts(regexp_extract_all(html, '{_ANCHOR_SQL}', 1), 1) AS ord
  FROM pages
),
links AS (
  SELECT page_id, ord::BIGINT AS ord,
    CASE WHEN starts_with(href, '/') THEN regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) || replace(href, '&amp;', '&') ELSE href END AS url,
    trim(regexp_replace(replace(regexp_replace(inner_html, '<[^>]*>?', ' ', 'g'), '&amp;', '&'), '[ \\t]+', ' ', 'g')) AS text
  FROM raw_links
)"""

SQL_PAGE_EDGES = f"""
page_edges AS (
  SELECT page_id AS doc, ord, {sql_pick(EDGE_HEADINGS, 'ord - 1')} AS heading,
    CASE WHEN ord % 6 = 0 THEN '' ELSE {sql_number('length(text) * 7 + ord')} END AS ref_number,
    text || ' số ' || {sql_number('length(text) * 7 + ord')} AS item
  FROM links
)"""
