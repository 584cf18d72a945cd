"""Listing pages, links, page texts and document pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import html as H
from vellum.functions import text as T
from vellum.functions import urls as U
from vellum.operators import documents as D
from vellum.operators import listing as O
from vellum.operators import sequences as S
from vellum.operators.dedup import keyword_union, merge_first, merge_sources
from vellum.plans.adapters import (
    LISTING_RULES, SQL_LINKS, SQL_LISTING, SQL_PAGE_EDGES, SQL_REGISTER, links, listing, number_of,
    page_edges, register, spread, sql_number, sql_pick, table,
)
from vellum.plans.registry import query
from vellum.sources.config import config_issues as find_config_issues
from vellum.sources.config import expand_fields as expand
from vellum.sources.config import page_frontier as frontier

WITH = f"WITH {SQL_LISTING}"
_KIND = "(CASE WHEN doc_type = '' THEN 'Luật' ELSE doc_type END)"
_REASON = f"""CASE WHEN NOT regexp_matches(url, '/(en|fr|de)/') THEN 'required_url_path_contains'
  WHEN {_KIND} NOT IN ('Thông tư', 'Nghị định', 'Luật', 'Bộ luật') THEN 'doc_type'
  WHEN contains(lower(title), 'ande') OR contains(lower(title), 'que') THEN 'exclude_title_keywords'
  WHEN contains(url, 'spam-farm') OR contains(url, 'cheap-pills') THEN 'exclude_url_keywords'
  WHEN contains(lower(doc_number), '/qh1') THEN 'exclude_so_hieu_keywords' ELSE '' END"""
_OUTCOMES = f"""judged AS (SELECT *, {_REASON} AS reason FROM listing),
 kept_ AS (SELECT field_code, url, min(ord) AS first_kept FROM judged WHERE reason = '' GROUP BY 1, 2),
 outcomes AS (SELECT j.*, CASE WHEN k.first_kept < j.ord THEN 'duplicate_url' ELSE reason END AS outcome
   FROM judged j LEFT JOIN kept_ k ON j.field_code = k.field_code AND j.url = k.url)"""


@query("""SELECT page_id, (url LIKE '%/en/%' OR url LIKE '%/fr/%' OR url LIKE '%/de/%') AND NOT url LIKE '%/es/%' AS kept FROM pages""")
def url_path_filter(spark, folder):
    rows = table(spark, folder, "pages")
    return rows.select("page_id", U.url_path_filter("url", LISTING_RULES.required_paths, LISTING_RULES.excluded_paths).alias("kept"))


@query(f"{WITH} SELECT ord, {_REASON} AS reason FROM listing")
def listing_reject(spark, folder):
    return listing(spark, folder).select("ord", O.listing_reject_reason(LISTING_RULES).alias("reason"))


@query(
    f"""{WITH} SELECT ord, NOT (contains(lower(title), 'ande') OR contains(lower(title), 'que') OR contains(url, 'spam-farm') OR contains(url, 'cheap-pills')
      OR contains(lower(doc_number), '/qh1')) AS passes FROM listing"""
)
def listing_keyword_filter(spark, folder):
    return listing(spark, folder).select("ord", O.listing_keyword_filter(LISTING_RULES).alias("passes"))


def _outcomes(spark, folder):
    return O.listing_outcomes(listing(spark, folder), LISTING_RULES, ["field_code"], ["ord"])


@query(f"{WITH}, {_OUTCOMES} SELECT ord, outcome FROM outcomes")
def listing_outcomes(spark, folder):
    return _outcomes(spark, folder).select("ord", "outcome")


_COUNTS = """count(*) AS input_links, count(*) FILTER (WHERE outcome = '') AS kept_links, count(*) FILTER (WHERE outcome = 'duplicate_url') AS duplicate_url,
  count(*) FILTER (WHERE outcome = 'required_url_path_contains') AS required_url_path_contains, count(*) FILTER (WHERE outcome = 'doc_type') AS doc_type,
  count(*) FILTER (WHERE outcome = 'exclude_title_keywords') AS exclude_title_keywords, count(*) FILTER (WHERE outcome = 'exclude_url_keywords') AS exclude_url_keywords,
  count(*) FILTER (WHERE outcome = 'exclude_so_hieu_keywords') AS exclude_so_hieu_keywords, 0::BIGINT AS other"""


@query(f"{WITH}, {_OUTCOMES} SELECT field_code, {_COUNTS} FROM outcomes GROUP BY field_code")
def listing_stats(spark, folder):
    return O.filter_stats(_outcomes(spark, folder), ["field_code"])


@query(f"{WITH}, {_OUTCOMES} SELECT field_code, page_index, {_COUNTS} FROM outcomes GROUP BY field_code, page_index")
def listing_page_stats(spark, folder):
    return O.filter_stats(_outcomes(spark, folder), ["field_code", "page_index"])


_PAGE_TOTALS = """per AS (SELECT field_code, page_index, count(*) AS document_count, count(*) FILTER (WHERE outcome = '') AS new_count FROM outcomes GROUP BY 1, 2)"""


def _page_totals(spark, folder):
    return _outcomes(spark, folder).groupBy("field_code", "page_index").agg(
        F.count(F.lit(1)).alias("document_count"), F.count_if(F.col("outcome") == "").alias("new_count")
    )


@query(
    f"""{WITH}, {_OUTCOMES}, {_PAGE_TOTALS} SELECT *, sum(new_count) OVER (PARTITION BY field_code ORDER BY page_index)::BIGINT AS total_so_far FROM per"""
)
def page_running_totals(spark, folder):
    return S.running_totals(_page_totals(spark, folder), ["field_code"])


@query(
    f"""{WITH}, {_OUTCOMES}, {_PAGE_TOTALS} SELECT count(*) AS page_count, sum(new_count)::BIGINT AS document_count, count(*) FILTER (WHERE new_count = 0) AS empty_page_count FROM per"""
)
def page_debug_summary(spark, folder):
    return O.page_debug_summary(_page_totals(spark, folder).withColumn("document_count", F.col("new_count")))


@query(
    f"""{WITH}, {_OUTCOMES} SELECT field_code, count(*) AS announced_total, count(*) FILTER (WHERE outcome = '') AS document_count, count(DISTINCT page_index) AS page_count,
      count(*) FILTER (WHERE outcome = 'duplicate_url') AS duplicates FROM outcomes GROUP BY field_code"""
)
def branch_summary(spark, folder):
    """Documents, pages and statistics per branch, from rows already counted per page."""
    per_page = O.filter_stats(_outcomes(spark, folder), ["field_code", "page_index"])
    fields = per_page.groupBy("field_code").agg(
        F.sum("input_links").alias("total_count_from_first_page"), F.sum("kept_links").alias("document_count"),
        F.count(F.lit(1)).alias("page_count"),
        F.create_map(F.lit("duplicate_url"), F.sum("duplicate_url")).alias("filter_debug_stats"),
    )
    named = fields.withColumns({"field_name": F.col("field_code"), "crawl_doc_type_id": F.lit("")})
    return O.branch_summary(named).select(
        "field_code", "announced_total", "document_count", "page_count", F.col("filter_debug_stats")["duplicate_url"].alias("duplicates")
    )


@query(
    f"""{WITH}, {_OUTCOMES} SELECT ord, field_code, row_number() OVER (PARTITION BY field_code ORDER BY ord) AS list_position FROM outcomes WHERE outcome = ''"""
)
def listing_numbers(spark, folder):
    kept = _outcomes(spark, folder).filter("outcome = ''").select("ord", "field_code")
    return S.listing_numbering(kept, ["field_code"], "ord")


@query(f"{WITH} SELECT ord, row_number, row_top, url FROM listing ORDER BY row_number NULLS LAST, row_top, url")
def listing_in_order(spark, folder):
    return O.listing_order(listing(spark, folder)).select("ord", "row_number", "row_top", "url")


@query(f"{WITH}, {_OUTCOMES} SELECT ord, url FROM outcomes WHERE outcome = '' ORDER BY ord LIMIT 50")
def capped_documents(spark, folder):
    return O.capped_documents(_outcomes(spark, folder).filter("outcome = ''").select("ord", "url"), "ord", 50)


_ISSUES = f"""issues AS (SELECT ord, list_filter([
    CASE WHEN url LIKE '%/es/%' THEN 'excluded_path:es' END,
    CASE WHEN NOT regexp_matches(url, '/(en|fr|de)/') THEN 'not_in_required_paths' END,
    CASE WHEN contains(url, 'spam-farm') THEN 'blocked_url_keyword:spam-farm' WHEN contains(url, 'cheap-pills') THEN 'blocked_url_keyword:cheap-pills' END,
    CASE WHEN contains(lower(title), 'ande') THEN 'title_keyword:ande' WHEN contains(lower(title), 'que') THEN 'title_keyword:que' END,
    CASE WHEN contains(doc_number, '/QH1') THEN 'number_keyword:/QH1' END,
    CASE WHEN doc_type = 'Quyết định' THEN 'skipped_doc_type:Quyết định' END,
    CASE WHEN doc_type = 'Quyết định' THEN 'not_accepted_doc_type:Quyết định' END], lambda x: x IS NOT NULL) AS errors,
  list_filter([CASE WHEN doc_type = '' THEN 'missing_doc_type' END, CASE WHEN doc_number = '' THEN 'missing_doc_number' END], lambda x: x IS NOT NULL) AS warnings FROM listing)"""


def _issues(spark, folder):
    return listing(spark, folder).select("ord", O.listing_errors(LISTING_RULES).alias("errors"), O.listing_warnings().alias("warnings"))


@query(f"{WITH}, {_ISSUES} SELECT ord, array_to_string(errors, '|') AS errors, array_to_string(warnings, '|') AS warnings FROM issues")
def listing_issues(spark, folder):
    return _issues(spark, folder).select("ord", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"))


@query(
    f"""{WITH}, {_ISSUES} SELECT count(*) AS total, count(*) FILTER (WHERE len(errors) > 0) AS invalid, count(*) FILTER (WHERE len(warnings) > 0) AS warned,
      count(*) FILTER (WHERE len(errors) = 0 AND len(warnings) = 0) AS clean FROM issues"""
)
def issue_counts(spark, folder):
    return O.issue_counts(_issues(spark, folder))


# --- URLs -----------------------------------------------------------------------------------
@query(
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^([^?#]*)', 1) AS base, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages)
    SELECT page_id, rtrim(regexp_replace(url, '#.*$', ''), '/') AS normal, regexp_extract(base, '^[a-z]+://[^/]*(.*)$', 1) AS path,
      '/' || trim(regexp_extract(base, '^[a-z]+://[^/]*(.*)$', 1), '/') || '/' AS slashed,
      base || CASE WHEN contains(q, 'page=2') THEN '?' || replace(q, 'page=2', 'page=a+b%26c') WHEN q = '' THEN '?page=a+b%26c' ELSE '?' || q || '&page=a+b%26c' END AS set_page,
      base || CASE WHEN q IN ('', 'ref=x') THEN '' ELSE '?' || replace(q, '&ref=x', '') END AS no_ref,
      base || '?' || CASE WHEN q = '' THEN '' ELSE q || '&' END || 'PageSize=20&PageIndex=' || (page_id + 1) AS page_url FROM p"""
)
def url_forms(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", U.normalize_url("url").alias("normal"), U.url_path("url").alias("path"), U.slashed_path("url").alias("slashed"),
        U.set_query_param("url", "page", "a b&c").alias("set_page"), U.remove_query_param("url", "ref").alias("no_ref"),
        U.build_page_url("url", F.col("page_id") + 1, 20).alias("page_url"),
    )


@query(f"""WITH {SQL_REGISTER} SELECT _row_number, true AS is_document FROM register UNION ALL SELECT page_id, false FROM pages""")
def document_urls(spark, folder):
    rows = register(spark, folder).select("_row_number", "url").unionByName(
        table(spark, folder, "pages").select(F.col("page_id").alias("_row_number"), "url")
    )
    return rows.select("_row_number", U.is_document_url("url", "register.example.org").alias("is_document"))


@query(
    """WITH f AS (SELECT c_mktsegment, c_nationkey, count(*) AS total, 'https://list.example.org/' || lower(c_mktsegment) || '.html?n=' || c_nationkey AS list_url FROM customer GROUP BY 1, 2),
    e AS (SELECT *, unnest(generate_series(1, ((total + 19) // 20)::INT)) AS page_index FROM f)
    SELECT c_mktsegment, c_nationkey, list_url, page_index::INT AS page_index, list_url || '&PageSize=20&PageIndex=' || page_index AS page_url FROM e"""
)
def page_frontier(spark, folder):
    fields = table(spark, folder, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("total"))
    url = F.concat(F.lit("https://list.example.org/"), F.lower("c_mktsegment"), F.lit(".html?n="), F.col("c_nationkey").cast("string"))
    return frontier(fields.withColumn("list_url", url), ["c_mktsegment", "c_nationkey"])


@query(
    """WITH f AS (SELECT s_suppkey, 'https://list.example.org/a.html?DocTypeId=9&n=' || s_nationkey AS u,
        CASE WHEN s_nationkey % 3 = 0 THEN ['21', '11'] WHEN s_nationkey % 3 = 1 THEN ['11', '10'] ELSE [''] END AS ids FROM supplier WHERE s_acctbal > 0)
    SELECT s_suppkey, i AS crawl_doc_type_id, CASE WHEN i = '' THEN u ELSE replace(u, 'DocTypeId=9', 'DocTypeId=' || i) END AS list_url FROM (SELECT *, unnest(ids) AS i FROM f)"""
)
def expand_fields(spark, folder):
    n = F.col("s_nationkey") % 3
    texts = lambda *v: F.array(*[F.lit(x) for x in v])
    none = F.array().cast("array<string>")
    fields = table(spark, folder, "supplier").select(
        "s_suppkey", (F.col("s_acctbal") > 0).alias("enabled"),
        F.concat(F.lit("https://list.example.org/a.html?DocTypeId=9&n="), F.col("s_nationkey").cast("string")).alias("list_url"),
        F.when(n == 0, texts("21", "11")).otherwise(none).alias("doc_type_ids"),
        F.when(n == 1, texts("Nghị định", " Luật ", "Công văn", "Nghị định")).otherwise(texts("Chỉ thị")).alias("accepted_doc_types"),
    )
    return expand(fields).select("s_suppkey", "crawl_doc_type_id", "list_url")


@query(
    """WITH c AS (SELECT s_suppkey AS config_id, s_nationkey % 4 AS n FROM supplier)
    SELECT config_id, 'CONFIG_DOC_TYPE_IDS_NOT_MATCH_CONFIRMED_SET' AS code, 'missing: 10, 58; extra: 99' AS message, 'error' AS severity FROM c WHERE n IN (1, 3)
    UNION ALL SELECT config_id, 'CONFIG_ACCEPTED_DOC_TYPES_MISSING', 'Bộ luật, Nghị định', 'error' FROM c WHERE n IN (2, 3)
    UNION ALL SELECT config_id, 'CONFIG_RUN_MODE_EMPTY', 'run_mode is blank', 'warning' FROM c WHERE n = 0
    UNION ALL SELECT config_id, 'CONFIG_EXCLUDE_URL_KEYWORD_HAS_SEMICOLON', 'ke-hoach;', 'error' FROM c WHERE n = 3"""
)
def config_issues(spark, folder):
    n = F.col("s_nationkey") % 4
    texts = lambda *v: F.array(*[F.lit(x) for x in v])
    configs = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("config_id"),
        F.when(n.isin(1, 3), texts("21", "11 ", "99")).otherwise(texts("58", "10", "11", "21", "21")).alias("doc_type_ids"),
        F.when(n.isin(2, 3), texts("Thông tư", "Luật")).otherwise(F.array().cast("array<string>")).alias("accepted_doc_types"),
        F.when(n == 3, texts("cong-van", "ke-hoach;")).otherwise(texts("cong-van")).alias("url_keywords"),
        F.when(n == 0, " ").otherwise("all").alias("run_mode"),
    )
    return find_config_issues(configs)


@query("""SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN 'dat-dai|hinh-su|moi' ELSE 'dat-dai|hinh-su|x' END AS words FROM supplier""")
def keyword_union_rows(spark, folder):
    own = F.when(F.col("s_nationkey") % 2 == 0, F.array(F.lit(" Moi; "), F.lit("hinh-su"), F.lit(""))).otherwise(F.array(F.lit("x"), F.lit("X")))
    return table(spark, folder, "supplier").select("s_suppkey", F.array_join(keyword_union(["dat-dai", "hinh-su"], own), "|").alias("words"))


# --- pages ----------------------------------------------------------------------------------
@query(f"WITH {SQL_LINKS} SELECT page_id, ord, url, text FROM links")
def page_links(spark, folder):
    return links(spark, folder)


_SCRIPTLESS = "regexp_replace(html, '(?is)<(script|style)\\b.*?</(?:script|style)>', ' ', 'g')"
_UNESCAPED = "replace(replace(replace(replace(replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
_TEXT = "trim(regexp_replace(" + _UNESCAPED.format(f"regexp_replace({_SCRIPTLESS}, '<[^>]*>?', ' ', 'g')") + ", '[\\s\\x{00A0}]+', ' ', 'g'))"


@query(f"SELECT page_id, md5({_TEXT}) AS digest, length({_TEXT}) AS chars FROM pages")
def page_text(spark, folder):
    text = H.html_to_text("html")
    return table(spark, folder, "pages").select("page_id", text.alias("t")).select(
        "page_id", F.md5("t").alias("digest"), F.length("t").cast("long").alias("chars")
    )


_TITLED = f"""t AS (SELECT page_id, {_TEXT} AS body, trim(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&amp;', '&')) AS title FROM pages)"""


@query(
    f"""WITH {_TITLED} SELECT page_id, CASE WHEN contains(lower(title || e'\\n' || body), '404') OR contains(lower(title || e'\\n' || body), 'not found') OR trim(title || body) = ''
      THEN 'error_or_empty' ELSE 'ok' END AS page_class FROM t"""
)
def page_class(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", H.page_title("html").alias("title"), H.html_to_text("html").alias("body"))
    return rows.select("page_id", H.classify_page("title", "body").alias("page_class"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 1000 * (page_id % 9 + 1) + 234 WHEN 1 THEN page_id WHEN 2 THEN 77 ELSE 0 END::BIGINT AS total FROM pages""")
def announced_totals(spark, folder):
    k = F.col("page_id")
    note = (
        F.when(k % 4 == 0, F.concat(F.lit(" Có tất cả "), (k % 9 + 1).cast("string"), F.lit(".234 văn bản. Tìm thấy 5 văn bản")))
        .when(k % 4 == 1, F.concat(F.lit(" Tìm  thấy "), k.cast("string"), F.lit(" Văn bản")))
        .when(k % 4 == 2, F.lit(" 7,7 văn bản mới"))
        .otherwise(" văn bản")
    )
    return table(spark, folder, "pages").select("page_id", H.announced_total(F.concat(H.html_to_text("html"), note)).alias("total"))


_BOXES = """boxes AS (SELECT page_id, ord, text, (ord * 37 % 1200)::DOUBLE AS left_, (ord * 53 % 900)::DOUBLE AS top, (page_id % 3 * 600)::DOUBLE AS vw FROM links)"""


@query(
    f"""WITH {SQL_LINKS}, {_BOXES} SELECT page_id, ord, NOT (vw > 0 AND left_ > vw * 0.72) AS row_ok, NOT (vw > 0 AND left_ > vw * 0.75) AND top >= 220 AS anchor_ok FROM boxes"""
)
def main_column(spark, folder):
    boxes = links(spark, folder).select(
        "page_id", "ord", (F.col("ord") * 37 % 1200).cast("double").alias("left"), (F.col("ord") * 53 % 900).cast("double").alias("top"),
        (F.col("page_id") % 3 * 600).cast("double").alias("viewport_width"),
    )
    return boxes.select("page_id", "ord", O.main_column_rows().alias("row_ok"), O.main_column_anchors().alias("anchor_ok"))


@query(
    """WITH d AS (SELECT doc_id, text, list_transform(string_split(text, e'\\n'), lambda x: trim(x)) AS lines FROM documents)
    SELECT doc_id, (len(list_filter(lines, lambda x: regexp_matches(x, '^[0-9]{1,4}\\s+'))) > 0 OR contains(text, ' the ') OR contains(text, ' que '))
      AND NOT (contains(lower(text), 'tion') AND NOT (contains(lower(text), 'oned') OR contains(lower(text), 'aux'))) AS kept FROM d"""
)
def row_markers(spark, folder):
    rows = table(spark, folder, "documents")
    keep = O.row_marker_filter(H.text_lines("text"), F.col("text"), ["Oned", "aux"], hints=[" the ", " que "], marker="tion")
    return rows.select("doc_id", keep.alias("kept"))


@query(
    f"""WITH {SQL_LINKS}, l AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS rn FROM links),
    t AS (SELECT doc_id // 4 AS page_id, doc_id, 'T' || n_chars AS title, row_number() OVER (PARTITION BY doc_id // 4 ORDER BY doc_id) AS rn FROM documents),
    pairs AS (SELECT l.page_id, l.url, t.title, (t.doc_id % 100)::INT AS row_number, l.ord AS link_ord, row_number() OVER (PARTITION BY l.page_id, l.url ORDER BY rn) AS use FROM l JOIN t USING (page_id, rn)),
    good AS (SELECT page_id, url, title, row_number, link_ord FROM pairs WHERE use = 1)
    SELECT * FROM good UNION ALL SELECT page_id, url, text, NULL, ord FROM links WHERE text <> '' AND (page_id, url) NOT IN (SELECT page_id, url FROM good)"""
)
def pair_by_rank(spark, folder):
    texts = table(spark, folder, "documents").select(
        F.expr("doc_id div 4").alias("page_id"), F.col("doc_id").alias("ord"), (F.col("doc_id") % 100).cast("int").alias("number"),
        F.concat(F.lit("T"), F.col("n_chars").cast("string")).alias("title"),
    )
    return O.pair_by_rank(texts, links(spark, folder).withColumnRenamed("text", "title"), ["page_id"])


@query(
    f"""WITH {SQL_LINKS}, both_ AS (SELECT 0 AS s, page_id, url, text, ord FROM links UNION ALL SELECT 1, page_id, url, text || ' mới', ord FROM links WHERE length(text) > 5)
    SELECT page_id, url, text, ord FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY length(text) DESC, s, ord) AS rn FROM both_) WHERE rn = 1"""
)
def merged_reads(spark, folder):
    first = links(spark, folder)
    second = first.filter(F.length("text") > 5).withColumn("text", F.concat("text", F.lit(" mới")))
    return merge_sources([first, second], ["page_id", "url"], "text", ["ord"])


@query(f"""WITH {SQL_LINKS} SELECT page_id, url, text, ord FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY ord) AS rn FROM links) WHERE rn = 1""")
def merged_first_reads(spark, folder):
    return merge_first([links(spark, folder), links(spark, folder)], ["page_id", "url"], ["ord"])


# --- sequences --------------------------------------------------------------------------------
@query(
    """WITH RECURSIVE firsts AS (SELECT conv_id, role, min(turn + 1) AS f FROM conversations WHERE turn + 1 <= 8 GROUP BY 1, 2),
    att AS (SELECT conv_id, max(turn + 1) AS n FROM conversations WHERE turn + 1 <= 8 GROUP BY 1),
    steps AS (SELECT a.conv_id, a.n, k, (SELECT count(*) FROM firsts WHERE firsts.conv_id = a.conv_id AND f <= k) AS merged,
       (SELECT count(*) FROM firsts WHERE firsts.conv_id = a.conv_id AND f IN (k, k - 1)) AS fresh FROM att a, generate_series(1, 8) g(k) WHERE k <= a.n),
    stops AS (SELECT conv_id, min(k) AS stop FROM steps WHERE k >= 4 AND fresh = 0 GROUP BY 1)
    SELECT a.conv_id AS page, a.n AS attempts, s.stop::INT AS stop_attempt, s.stop IS NOT NULL AS converged,
      (SELECT merged FROM steps WHERE steps.conv_id = a.conv_id AND k = coalesce(s.stop, a.n)) AS merged_count FROM att a LEFT JOIN stops s USING (conv_id)"""
)
def attempt_convergence(spark, folder):
    rows = table(spark, folder, "conversations").select(F.col("conv_id").alias("page"), (F.col("turn") + 1).alias("attempt"), F.col("role").alias("item"))
    return S.snapshot_convergence(rows, ["page"], "item")


_DAILY = """d AS (SELECT o_orderpriority AS field, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS page_index, count(*) FILTER (WHERE o_totalprice > 400000) AS document_count FROM orders GROUP BY 1, 2),
 stops AS (SELECT a.field, min(a.page_index) AS stop_page FROM d a JOIN d b ON a.field = b.field AND a.page_index = b.page_index + 1 WHERE a.document_count = 0 AND b.document_count = 0 GROUP BY 1)"""


def _daily(spark, folder):
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) + 1
    return table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("field"), day.alias("page_index")).agg(
        F.count_if(F.col("o_totalprice") > 400000).alias("document_count")
    )


@query(f"WITH {_DAILY} SELECT field, max(page_index) AS last_page, any_value(stop_page) AS stop_page FROM d LEFT JOIN stops USING (field) GROUP BY field")
def empty_streak(spark, folder):
    return S.empty_streak_stop(_daily(spark, folder), ["field"])


@query(f"WITH {_DAILY} SELECT d.* FROM d LEFT JOIN stops USING (field) WHERE stop_page IS NULL OR page_index <= stop_page")
def pages_before_stop(spark, folder):
    return S.pages_before_stop(_daily(spark, folder), ["field"])


@query(
    """SELECT event_id, user_id, CASE WHEN n < 1000 THEN 'VB' || lpad(n::VARCHAR, 3, '0') ELSE 'VB' || n END AS sequence_id FROM (
      SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) + 173 AS n FROM events WHERE event_type <> 'error')"""
)
def sequence_ids(spark, folder):
    rows = table(spark, folder, "events").filter("event_type <> 'error'").select("event_id", "user_id")
    return S.assign_sequence(rows, "event_id")


_LINES = """raw_lines AS (SELECT doc_id, trim(regexp_replace(unnest(string_split(text, e'\\n')), '[ \\t]+', ' ', 'g')) AS x, generate_subscripts(string_split(text, e'\\n'), 1) AS i FROM documents),
 named AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM raw_lines WHERE x <> ''),
 lines AS (SELECT doc_id, i, CASE WHEN i % 3 = 1 THEN (i % 1000) || ' ' || x WHEN i % 7 = 3 THEN (i % 1000)::VARCHAR ELSE x END AS x FROM named)"""
_MARKERS = [" the ", " que ", " und ", " los "]


def _lines():
    return F.transform(
        H.text_lines("text"),
        lambda x, i: F.when((i + 1) % 3 == 1, F.concat(((i + 1) % 1000).cast("string"), F.lit(" "), x))
        .when((i + 1) % 7 == 3, ((i + 1) % 1000).cast("string")).otherwise(x),
    )


@query(
    f"""WITH {_LINES}, starts AS (SELECT *, regexp_matches(x, '^[0-9]{{1,4}}( .+)?$') AS is_start FROM lines),
    seg AS (SELECT *, sum(is_start::INT) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM starts),
    cutpos AS (SELECT *, CASE WHEN is_start THEN NULL WHEN contains(x, ' the ') THEN string_split(x, ' the ')[1] WHEN contains(x, ' que ') THEN string_split(x, ' que ')[1]
       WHEN contains(x, ' und ') THEN string_split(x, ' und ')[1] WHEN contains(x, ' los ') THEN string_split(x, ' los ')[1] END AS cut_text FROM seg WHERE s > 0),
    stops AS (SELECT doc_id, s, min(i) FILTER (WHERE cut_text IS NOT NULL) AS stop_i FROM cutpos GROUP BY 1, 2),
    texts AS (SELECT c.doc_id, c.s, c.i, CASE WHEN is_start THEN regexp_extract(x, '^[0-9]{{1,4}} (.+)$', 1) WHEN c.i = stop_i THEN cut_text ELSE x END AS t, is_start, x
       FROM cutpos c JOIN stops USING (doc_id, s) WHERE stop_i IS NULL OR c.i <= stop_i)
    SELECT doc_id, n AS number, md5(title) AS title_digest, count(*) AS n FROM (
      SELECT doc_id, s, max(regexp_extract(x, '^([0-9]+)', 1)) FILTER (WHERE is_start) AS n, string_agg(trim(t), ' ' ORDER BY i) FILTER (WHERE trim(t) <> '') AS title FROM texts GROUP BY 1, 2)
    WHERE title <> '' GROUP BY 1, 2, 3"""
)
def numbered_rows(spark, folder):
    pages = table(spark, folder, "documents").select("doc_id", _lines().alias("lines"))
    rows = S.numbered_rows(pages, "lines", ["doc_id"], _MARKERS)
    return rows.groupBy("doc_id", F.col("number").cast("string").alias("number"), F.md5("title").alias("title_digest")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {_LINES}, b AS (SELECT doc_id, min(i) FILTER (WHERE contains(x, 'tion')) AS a FROM lines GROUP BY 1),
    e AS (SELECT l.doc_id, min(i) AS z FROM lines l JOIN b USING (doc_id) WHERE contains(x, 'that') AND i > coalesce(a, 0) GROUP BY 1)
    SELECT d.doc_id, coalesce(md5(string_agg(x, '|' ORDER BY i) FILTER (WHERE i > coalesce(a, 0) AND i < coalesce(z, 1000000))), md5('')) AS digest
    FROM (SELECT doc_id FROM documents) d LEFT JOIN lines USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id) GROUP BY 1"""
)
def marker_slices(spark, folder):
    pages = table(spark, folder, "documents").select("doc_id", _lines().alias("lines"))
    rows = S.slice_between_markers(pages, "lines", "part", ["tion"], ["that"])
    return rows.select("doc_id", F.md5(F.array_join("part", "|")).alias("digest"))


# --- texts and numbers ------------------------------------------------------------------------
@query(
    """WITH n AS (SELECT doc_id, text, trim(regexp_replace(regexp_replace(replace(text, chr(160), ' '), '[ \\t]+', ' ', 'g'), '\\n{2,}', e'\\n', 'g'), e' \\t\\n\\r') AS t FROM documents)
    SELECT doc_id, md5(t) AS digest, length(t) AS chars, CASE WHEN length(t) > 40 THEN substr(t, 1, 40) || '...' ELSE t END AS short FROM n"""
)
def clean_texts(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", T.normalize_text("text").alias("t"))
    return rows.select("doc_id", F.md5("t").alias("digest"), F.length("t").cast("long").alias("chars"), T.short_text("t", 40).alias("short"))


@query(
    f"""WITH {SQL_LINKS}, {SQL_PAGE_EDGES} SELECT doc, ord, {sql_number('length(text) * 7 + ord')} AS first_number, 1 + (ord % 2) AS numbers,
      CASE WHEN ord % 2 = 1 THEN '45/2021/NĐ-CP' ELSE {sql_number('length(text) * 7 + ord')} END AS primary_number,
      {sql_pick(['Thông tư', 'Nghị định', ''], 'ord')} AS doc_type
    FROM (SELECT page_id AS doc, ord, text FROM links) """
)
def text_numbers(spark, folder):
    n = F.col("ord")
    number = number_of(F.length("text") * 7 + n)
    shown = F.concat(
        F.when(n % 3 == 0, "12) Thông tư ").when(n % 3 == 1, "về việc nghị định ").otherwise("các nghị địnhs "),
        F.lower(number), F.lit(" của "), F.when(n % 2 == 1, "cơ quan, số  45/2021/nđ-cp.").otherwise("cơ quan"),
    )
    rows = links(spark, folder).select(F.col("page_id").alias("doc"), "ord", shown.alias("t"))
    return rows.select(
        "doc", "ord", F.upper(T.document_number("t")).alias("first_number"), F.size(T.document_numbers("t")).cast("long").alias("numbers"),
        T.primary_number("t").alias("primary_number"), T.document_type("t").alias("doc_type"),
    )


@query(
    f"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_partkey || '/2020/TT-BGDĐT' WHEN 1 THEN p_partkey || '/2020/NĐ-CP' WHEN 2 THEN p_partkey || '/2020/QH15' ELSE p_partkey || '/TT-GDDT' END AS number,
      substr(md5(CASE p_partkey % 4 WHEN 0 THEN p_partkey || '/2020/TT-BGDĐT' WHEN 1 THEN p_partkey || '/2020/NĐ-CP' WHEN 2 THEN p_partkey || '/2020/QH15' ELSE p_partkey || '/TT-GDDT' END), 1, 16) AS id,
      CASE WHEN p_partkey < 1000 THEN 'VB' || lpad(p_partkey::VARCHAR, 3, '0') ELSE 'VB' || p_partkey END AS sequence_id FROM part"""
)
def canonical_numbers(spark, folder):
    k = F.col("p_partkey")
    text = k.cast("string")
    raw = (
        F.when(k % 4 == 0, F.concat(text, F.lit(" /2020 / tt - gdđt ")))
        .when(k % 4 == 1, F.concat(text, F.lit("/2020/nd cp")))
        .when(k % 4 == 2, F.concat(text, F.lit("/2020/QH  15")))
        .otherwise(F.concat(text, F.lit("/TT-GDDT")))
    )
    rows = table(spark, folder, "part").select("p_partkey", T.canonical_number(raw).alias("number"))
    return rows.select("p_partkey", "number", T.stable_id("number", F.lit("u")).alias("id"), T.sequence_id("p_partkey").alias("sequence_id"))


@query(
    f"""WITH {SQL_LINKS}, {SQL_PAGE_EDGES} SELECT CASE heading WHEN 'Văn bản liên quan' THEN 'Văn bản liên quan' ELSE heading END AS heading,
      CASE WHEN ord % 3 = 0 THEN 'Đã gợi ý' ELSE 'Lỗi quét' END AS status, count(*) AS n FROM page_edges GROUP BY 1, 2"""
)
def canonical_headings(spark, folder):
    spelled = F.when(F.col("ord") % 2 == 0, F.concat(F.lit(" "), F.upper(F.substring("heading", 1, 1)), F.expr("substring(heading, 2)"), F.lit("  (12) "))).otherwise(F.col("heading"))
    status = T.relation_status(F.when(F.col("ord") % 3 == 0, "khác").otherwise(" Lỗi quét "))
    rows = page_edges(spark, folder).select(T.canonical_heading(spelled).alias("heading"), status.alias("status"))
    return rows.groupBy("heading", "status").agg(F.count(F.lit(1)).alias("n"))


# --- document pages and payloads ----------------------------------------------------------------
def _page_lines():
    """Lines of a document page made of the register row's own values."""
    label = F.col("number")
    return F.array(
        F.lit("Trang chủ"), F.lit("Số hiệu:"), label, F.concat(F.lit("Cơ quan ban hành: "), F.col("department")),
        F.concat(F.lit("Ban hành: ngày "), F.col("effective_date"), F.lit(".")), F.concat(F.lit("Thông tư "), label, F.lit(" về "), F.col("title")),
        F.concat(F.lit("Lĩnh vực: "), F.col("field")), F.concat(F.lit("Ngày áp dụng: "), F.col("status_date")), F.lit("Hiệu lực: Còn hiệu lực"),
    )


@query(
    f"""WITH {SQL_REGISTER} SELECT _row_number, CASE WHEN p < 10000 THEN number ELSE '' END AS number, 'Thông tư ' || number || ' về ' || title AS title, 'Thông tư' AS doc_type, department AS issuer, effective_date AS issued,
      substr(status_date, 1, 10) AS effective_date, field, 'Còn hiệu lực' AS validity FROM register"""
)
def document_fields(spark, folder):
    rows = spread(register(spark, folder)).select("_row_number", _page_lines().alias("lines"))
    return D.document_fields(rows, "lines").select("_row_number", "info.*")


@query(
    f"""SELECT page_id, CASE WHEN page_id < 10000 THEN {sql_number('page_id')} ELSE '' END AS number, 'Thông tư ' || {sql_number('page_id')} || ' về trang & số ' || page_id AS title,
      'Thông tư' AS doc_type, 'Bộ ' || (page_id % 7) AS issuer, lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || '/05/2021' AS issued,
      lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || '/06/2021' AS effective_date, 'Thuế' AS field, 'Còn hiệu lực' AS validity FROM pages"""
)
def page_document_fields(spark, folder):
    """Fields read from whole pages, each closed by a block of its own values, with entities in it."""
    number, text = number_of(F.col("page_id")), F.col("page_id").cast("string")
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    block = F.concat(
        F.lit("<div>S&#7889; hiệu:</div><p>"), F.when(F.col("page_id") < 10000, number).otherwise(F.lit("")),
        F.lit("</p><p>Cơ quan ban h&agrave;nh: B&#x1ED9; "), (F.col("page_id") % 7).cast("string"), F.lit("</p><p>Ban hành: ngày "), day, F.lit("/05/2021.</p><h1>Thông tư "), number,
        F.lit(" về trang &amp; số "), text, F.lit("</h1><p>Lĩnh vực: Thuế<br/>Ngày áp dụng: "), day, F.lit("/06/2021</p><p>Hiệu lực: Còn hiệu lực</p>"),
    )
    pages = table(spark, folder, "pages").select("page_id", H.html_lines(F.concat("html", block)).alias("lines"))
    return D.document_fields(pages, "lines").select("page_id", "info.*")


def _payloads(spark, folder):
    lined = D.document_fields(spread(register(spark, folder)).withColumn("lines", _page_lines()), "lines")
    rows = lined.withColumns({"doc_number": F.lower("number"), "mapped_field": F.col("field"), "_t": F.col("title")})
    shaped = rows.withColumns(
        {
            "title": F.when(F.col("_row_number") % 2 == 0, F.col("title")).otherwise(F.lit("")),
            "doc_number": F.when(F.col("_row_number") % 3 == 0, F.lit("")).otherwise(F.col("doc_number")),
            "field_name": F.col("field"), "field_code": F.col("topic"), "source_list_url": F.lit("l"),
            "sequence_id": F.lit(""), "scanned_at": F.lit("01/01/2024 00:00:00"), "basis_text": F.lit(""), "basis_hint": F.replace("amends", F.lit(", "), F.lit("\n")),
            "relation_note": F.lit(""), "has_relations": F.col("amends") != "",
        }
    )
    return D.build_payload(shaped, "Nguồn")


# a document number has at most four digits before the year, so longer keys are not read from pages
_PAYLOADS = f"""payloads AS (SELECT substr(md5(CASE WHEN no = '' THEN url WHEN _row_number % 3 = 0 THEN no ELSE lower(no) END), 1, 16) AS id, field, doc_type_ AS doc_type,
   CASE WHEN _row_number % 2 = 0 THEN title ELSE 'Thông tư ' || number || ' về ' || title END AS title, no AS number, substr(status_date, 1, 10) AS effective_date, url, amends,
   CASE WHEN amends <> '' THEN 'Đã gợi ý' ELSE 'Chưa quét' END AS relation_status, len(list_filter(string_split(amends, e'\\n'), lambda x: x <> '')) AS hints
  FROM (SELECT *, CASE WHEN doc_type = '' THEN 'Thông tư' ELSE doc_type END AS doc_type_, CASE WHEN _row_number % 3 = 0 AND p >= 10000 THEN '' ELSE number END AS no FROM register))"""


@query(f"""WITH {SQL_REGISTER}, {_PAYLOADS} SELECT id, field, doc_type, title, number, effective_date, url, amends, relation_status, hints::VARCHAR AS hints FROM payloads""")
def payload_rows(spark, folder):
    return _payloads(spark, folder).select(
        "id", "field", "doc_type", "title", "number", "effective_date", "url", "amends", "relation_status",
        F.regexp_extract("scan_note", r"gợi ý: (\d+)\.$", 1).alias("hints"),
    )


_HIT = "CASE WHEN contains(lower(title), 'blue') THEN 'blue' WHEN contains(lower(title), 'ring') THEN 'ring' END"


@query(
    f"""WITH {SQL_REGISTER}, {_PAYLOADS} SELECT id, CASE WHEN number = '' THEN 'missing:number' WHEN effective_date = '' THEN 'missing:effective_date' ELSE '' END AS required,
      CASE WHEN doc_type NOT IN ('Bộ luật', 'Luật', 'Nghị định', 'Thông tư') THEN 'not_in_accepted_doc_types:' || doc_type
        WHEN {_HIT} IS NOT NULL THEN 'exclude_title_keywords:' || {_HIT} WHEN contains(url, 'promo') THEN 'exclude_url_keywords:promo'
        WHEN contains(lower(number), '/qh') THEN 'exclude_so_hieu_keywords:/QH' ELSE '' END AS skip_reason,
      CASE WHEN number = '' THEN 'MISSING_SO_HIEU' WHEN doc_type = 'Quyết định' THEN 'SKIP_DOC_TYPE' WHEN doc_type NOT IN ('Bộ luật', 'Luật', 'Nghị định', 'Thông tư') THEN 'DOC_TYPE_NOT_ACCEPTED' ELSE '' END AS gate_code,
      array_to_string(list_filter([CASE WHEN doc_type = 'Quyết định' THEN 'skipped_doc_type:Quyết định' END, CASE WHEN number = '' THEN 'missing_number' END, CASE WHEN contains(url, 'promo') THEN 'blocked_url_keyword:promo' END,
         CASE WHEN {_HIT} IS NOT NULL THEN 'title_keyword:' || {_HIT} END, CASE WHEN contains(number, '/QH') THEN 'number_keyword:/QH' END], lambda x: x IS NOT NULL), '|') AS errors
    FROM payloads"""
)
def payload_gates(spark, folder):
    from vellum.sources.config import RuleSet

    rules = RuleSet(title_keywords=["Blue", "ring "], url_keywords=["PROMO"], number_keywords=["/QH"], skip_doc_types=["Quyết định"])
    rows = _payloads(spark, folder)
    return rows.select(
        "id", D.payload_required_message().alias("required"), D.payload_skip_reason(rules).alias("skip_reason"), D.write_gate_code().alias("gate_code"),
        F.array_join(O.payload_errors(rules), "|").alias("errors"),
    )


@query(
    f"""WITH {SQL_REGISTER}, {_PAYLOADS} SELECT id, CASE WHEN number = '' THEN 'Bỏ qua vì thiếu Số hiệu.' WHEN doc_type = 'Quyết định' THEN 'Bỏ qua vì Loại văn bản không dùng: Quyết định'
      WHEN doc_type NOT IN ('Bộ luật', 'Luật', 'Nghị định', 'Thông tư') THEN 'Bỏ qua vì Loại văn bản không thuộc nhóm dùng cho VBQPPL_Nhap: ' || doc_type ELSE '' END AS message FROM payloads"""
)
def gate_messages(spark, folder):
    rows = _payloads(spark, folder).withColumn("gate_code", D.write_gate_code())
    return rows.select("id", D.write_gate_message().alias("message"))


@query(
    """SELECT event_type, k, count(*) AS n, count(*) FILTER (WHERE event_type IN ('error', 'signup') OR k IN (408, 409, 425, 429)) AS retryable FROM (
      SELECT event_type, 400 + regexp_extract(props, '[0-9]+')::INT AS k FROM events) GROUP BY 1, 2"""
)
def retryable_errors(spark, folder):
    text = F.when(F.col("event_type") == "error", "HTTP: Connection RESET by peer").when(F.col("event_type") == "signup", "read timed out").otherwise("bad request")
    rows = table(spark, folder, "events").select("event_type", text.alias("message"), (F.get_json_object("props", "$.k").cast("int") + 400).alias("k"))
    marked = rows.withColumn("r", D.retryable("message", "k"))
    return marked.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"), F.count_if("r").alias("retryable"))
