"""References against the register: matches, missing ones, coverage, cells, reverse links."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import match_key, split_values, tracking_key
from vellum.operators import register as G
from vellum.operators import relations as X
from vellum.operators.dedup import dedup_first, dedup_longest, fallback_title, primary_link, register_index
from vellum.plans.adapters import (
    EDGE_HEADINGS, EDGE_ORDER, EDGE_SPREAD, SQL_EDGES, SQL_LINKS, SQL_PAGE_EDGES, SQL_REGISTER, edges, links, number_of,
    page_edges, register, sql_number, sql_percent, table,
)
from vellum.plans.registry import query
from vellum.session import shared_folder
from vellum.sources.missing_store import write_missing_snapshot
from vellum.sources.staging import staged

WITH = f"WITH {SQL_REGISTER}, {SQL_EDGES}"
OFFICIAL = ", ".join(f"'{h}'" for h in L.OFFICIAL_COLUMN_BY_HEADING)
TRACKED = ", ".join(f"'{h}'" for h in EDGE_HEADINGS if h in L.TRACKED_HEADINGS)


@query(f"""{WITH} SELECT doc, heading, ref_number, matched_id, matched_number, matched_row, l1, l2, l3, l4, matched_id IS NOT NULL AS is_matched FROM matched""")
def reference_match(spark, folder):
    matched = X.match_references(edges(spark, folder), register(spark, folder), EDGE_SPREAD)
    return matched.select("doc", "heading", "ref_number", "matched_id", "matched_number", "matched_row", *EDGE_ORDER, "is_matched")


@query(f"""{WITH} SELECT doc, number, l1::VARCHAR || '-' || l2 || '-' || l3 AS first_seen FROM (
    SELECT doc, ref_number AS number, l1, l2, l3, row_number() OVER (PARTITION BY doc, ref_number ORDER BY l1, l2, l3, l4) AS rn
    FROM matched WHERE matched_id IS NULL AND heading IN ({TRACKED})) WHERE rn = 1""")
def missing_refs(spark, folder):
    missing = X.missing_references(edges(spark, folder), register(spark, folder), ["doc"], EDGE_ORDER)
    seen = F.concat_ws("-", *[F.col(f"first_ord.{c}").cast("string") for c in ["l1", "l2", "l3"]])
    return missing.select("doc", "number", seen.alias("first_seen"))


@query(
    f"""{WITH}, per AS (SELECT heading, count(*) FILTER (WHERE matched_id IS NOT NULL) AS matched,
        count(*) FILTER (WHERE matched_id IS NULL) AS missing FROM matched GROUP BY heading),
      rolled AS (SELECT heading, 0 AS is_total, matched, missing FROM per UNION ALL SELECT NULL, 1, sum(matched)::BIGINT, sum(missing)::BIGINT FROM per)
    SELECT *, matched + missing AS total, {sql_percent('matched', 'matched + missing', 100.0)} AS coverage_percent FROM rolled"""
)
def match_coverage(spark, folder):
    return X.match_coverage(edges(spark, folder), register(spark, folder))


@query(
    f"""{WITH} SELECT doc, count(DISTINCT CASE WHEN matched_id IS NOT NULL THEN heading || matched_id END) AS matched_ids,
      count(*) FILTER (WHERE matched_id IS NULL) AS missing_items, true AS has_report FROM matched WHERE heading IN ({OFFICIAL}) GROUP BY doc"""
)
def doc_match_summary(spark, folder):
    return X.document_match_summary(edges(spark, folder), register(spark, folder), ["doc"])


_TRACK_SQL = "replace(replace(translate(upper(trim(ref_number)), 'Đ–—−‐', 'D----'), ' ', ''), '.', '')"
_GONE = f"""gone AS (SELECT *, {_TRACK_SQL} AS key FROM matched WHERE matched_id IS NULL AND heading IN ({OFFICIAL}))"""
_GONE_ORDER = "doc, l1, l2, l3, l4"
_ROLLUP = f"""rollup_ AS (
   SELECT key, count(*) AS count, arg_min(ref_number, (doc, l1, l2, l3, l4)) AS number, count(DISTINCT doc) AS source_count,
     (list(item ORDER BY {_GONE_ORDER}))[1:5] AS examples FROM gone GROUP BY key),
 heads AS (SELECT key, string_agg(heading, '|' ORDER BY o) AS headings FROM (SELECT key, heading, min((doc, l1, l2, l3, l4)) AS o FROM gone GROUP BY 1, 2) GROUP BY key)"""


def _rollup(spark, folder):
    missing = X.missing_edges(edges(spark, folder), register(spark, folder), EDGE_SPREAD)
    return X.missing_rollup(missing, ["doc", *EDGE_ORDER], "doc", "item")


@query(f"""{WITH}, {_GONE}, {_ROLLUP} SELECT key, number, count, source_count, headings, array_to_string(examples, '|') AS examples FROM rollup_ JOIN heads USING (key)""")
def missing_rollup(spark, folder):
    return _rollup(spark, folder).select(
        "key", "number", "count", "source_count", F.array_join("headings", "|").alias("headings"), F.array_join("examples", "|").alias("examples")
    )


@query(f"""{WITH}, {_GONE} SELECT key, doc, count(*) AS count, min(l1) AS first_line FROM gone GROUP BY key, doc""")
def missing_sources(spark, folder):
    missing = X.missing_edges(edges(spark, folder), register(spark, folder), EDGE_SPREAD)
    found = X.missing_sources(missing, ["doc", *EDGE_ORDER], "doc")
    return found.select("key", "doc", "count", F.col("first_ord.l1").alias("first_line"))


@query(f"""{WITH}, {_GONE}, {_ROLLUP} SELECT number, count, headings FROM rollup_ JOIN heads USING (key) ORDER BY count DESC, number LIMIT 20""")
def top_missing(spark, folder):
    top = X.top_missing(_rollup(spark, folder))
    return top.select("number", "count", F.array_join("headings", "|").alias("headings"))


@query(
    f"""{WITH}, raw AS (SELECT DISTINCT ref_number AS target_number, CASE heading WHEN 'Văn bản căn cứ' THEN 'guided_by' ELSE 'amends' END AS target_column,
        src_number AS value FROM matched WHERE heading IN ('Văn bản căn cứ', 'Văn bản sửa đổi, bổ sung'))
    SELECT target_number, target_column, value FROM raw"""
)
def reverse_links(spark, folder):
    return X.reverse_links(edges(spark, folder), ["doc", *EDGE_ORDER]).select("target_number", "target_column", "value")


@query(
    f"""{WITH}, placed AS (SELECT DISTINCT p + 2 AS _row_number, CASE heading WHEN 'Văn bản căn cứ' THEN 'guided_by' ELSE 'amends' END AS target_column, src_number AS value
        FROM edges WHERE heading IN ('Văn bản căn cứ', 'Văn bản sửa đổi, bổ sung') AND p IN (SELECT p FROM register)),
      existing AS (SELECT _row_number, 'guided_by' AS target_column, trim(unnest(regexp_split_to_array(guided_by, '[\\n,;]+'))) AS value FROM register
        UNION ALL SELECT _row_number, 'amends', trim(unnest(regexp_split_to_array(amends, '[\\n,;]+'))) FROM register)
    SELECT * FROM placed EXCEPT SELECT * FROM existing"""
)
def reverse_link_rows(spark, folder):
    reg = register(spark, folder)
    lists = reg.withColumns({c: split_values(c) for c in ["guided_by", "amends"]})
    fresh = X.apply_reverse_links(lists, X.reverse_links(edges(spark, folder), ["doc", *EDGE_ORDER]))
    return fresh.select("_row_number", "target_column", "value")


@query(
    f"""{WITH}, placed AS (SELECT p + 2 AS _row_number, CASE heading WHEN 'Văn bản căn cứ' THEN 'guided_by' ELSE 'amends' END AS target_column, src_number AS value,
        min((doc, l1, l2, l3, l4)) AS o FROM edges WHERE heading IN ('Văn bản căn cứ', 'Văn bản sửa đổi, bổ sung') AND p IN (SELECT p FROM register) GROUP BY 1, 2, 3),
      old AS (SELECT _row_number, guided_by, amends, list_filter(list_transform(regexp_split_to_array(guided_by, '[\\n,;]+'), lambda x: trim(x)), lambda x: x <> '') AS g,
        list_filter(list_transform(regexp_split_to_array(amends, '[\\n,;]+'), lambda x: trim(x)), lambda x: x <> '') AS a FROM register),
      fresh AS (SELECT p.* FROM placed p JOIN old r USING (_row_number) WHERE NOT list_contains(CASE target_column WHEN 'guided_by' THEN g ELSE a END, value)),
      cells AS (SELECT _row_number, list(value ORDER BY o) FILTER (WHERE target_column = 'guided_by') AS ng, list(value ORDER BY o) FILTER (WHERE target_column = 'amends') AS na FROM fresh GROUP BY 1)
    SELECT _row_number, CASE WHEN ng IS NULL THEN guided_by ELSE array_to_string(list_concat(g, ng), ', ') END AS guided_by,
      CASE WHEN na IS NULL THEN amends ELSE array_to_string(list_concat(a, na), ', ') END AS amends FROM old LEFT JOIN cells USING (_row_number)"""
)
def register_with_links(spark, folder):
    found = X.reverse_links(edges(spark, folder), ["doc", *EDGE_ORDER])
    return X.write_reverse_links(register(spark, folder), found).select("_row_number", "guided_by", "amends")


# --- cells per page -------------------------------------------------------------------------
PAGES = f"WITH {SQL_REGISTER}, {SQL_LINKS}, {SQL_PAGE_EDGES}"


@query(
    f"""{PAGES}, rows_ AS (SELECT * FROM page_edges WHERE item <> ''),
    cells AS (SELECT doc, heading, min(ord) AS o, count(*) AS n, coalesce(string_agg(ref_number, e'\\n' ORDER BY ord) FILTER (WHERE ref_number <> ''), '') AS nums,
        string_agg(item, e'\\n' ORDER BY ord) AS items,
        string_agg(CASE WHEN ref_number <> '' THEN '- ' || ref_number || ': ' || item ELSE '- ' || item END, e'\\n' ORDER BY ord) AS bullets
      FROM rows_ GROUP BY doc, heading)
    SELECT doc, coalesce(max(nums) FILTER (WHERE heading = 'Văn bản căn cứ'), '') AS basis,
      coalesce(max(nums) FILTER (WHERE heading = 'Văn bản hướng dẫn'), '') AS guided_by,
      coalesce(max(nums) FILTER (WHERE heading = 'Văn bản sửa đổi, bổ sung'), '') AS amends,
      coalesce(max(nums) FILTER (WHERE heading = 'Văn bản bị sửa đổi, bổ sung'), '') AS amended_by,
      coalesce(max(items) FILTER (WHERE heading = 'Văn bản căn cứ'), '') AS basis_text,
      coalesce(max(nums) FILTER (WHERE heading = 'Văn bản căn cứ'), '') AS basis_hint,
      string_agg('[' || heading || e']\\n{L.NOTE_COMPARE_LINE}\\nSố lượng: ' || n || e'\\n' || bullets, e'\\n\\n' ORDER BY o) AS relation_note
    FROM cells GROUP BY doc"""
)
def relation_columns(spark, folder):
    return X.relation_columns(page_edges(spark, folder), ["doc"]).drop("has_relations")


@query(
    f"""{PAGES}, rows_ AS (SELECT * FROM page_edges WHERE heading IN ({OFFICIAL}, 'Văn bản hướng dẫn'))
    SELECT doc, heading, count(*) AS items, string_agg(item, '|' ORDER BY ord) AS joined FROM rows_ GROUP BY doc, heading"""
)
def relation_nested(spark, folder):
    nested = X.relation_nested(page_edges(spark, folder), ["doc"])
    rows = nested.select("doc", F.explode("relations").alias("heading", "entries"))
    return rows.select(
        "doc", "heading", F.size("entries").cast("long").alias("items"), F.array_join(F.transform("entries", lambda e: e["item"]), "|").alias("joined")
    )


def _page_matches(spark, folder):
    return X.match_references(page_edges(spark, folder), register(spark, folder), ["doc", "ord"])


def _match_columns_sql(value: str, glue: str) -> str:
    return f"""{PAGES}, hits AS (SELECT e.doc, e.heading, r.{value} AS v, min(e.ord) AS o FROM page_edges e
        JOIN register r ON e.ref_number = r.number AND r.id <> '' WHERE e.heading IN ({OFFICIAL}) GROUP BY 1, 2, 3)
      SELECT doc, CASE heading WHEN 'Văn bản căn cứ' THEN 'basis' WHEN 'Văn bản được hướng dẫn' THEN 'guided_by'
        WHEN 'Văn bản bị sửa đổi, bổ sung' THEN 'amends' ELSE 'amended_by' END AS official_column, {glue} AS value FROM hits GROUP BY doc, heading"""


@query(_match_columns_sql("number", "string_agg(v, ', ' ORDER BY o)"))
def match_columns(spark, folder):
    return X.match_columns(_page_matches(spark, folder), ["doc"])


@query(_match_columns_sql("id", "string_agg(v, e'\\n' ORDER BY o)"))
def match_columns_ids(spark, folder):
    return X.match_columns(_page_matches(spark, folder), ["doc"], mode="id", strategy="multi_line")


@query(_match_columns_sql("number", "arg_min(v, o)"))
def match_columns_first(spark, folder):
    return X.match_columns(_page_matches(spark, folder), ["doc"], strategy="first_only")


@query(
    f"""{PAGES} SELECT doc, heading || ' - ' || ref_number AS note_line, min(ord) AS ord FROM page_edges
    WHERE heading IN ('Văn bản hướng dẫn', 'Văn bản thay thế') AND ref_number <> '' GROUP BY 1, 2"""
)
def relation_note_items(spark, folder):
    return X.note_items(page_edges(spark, folder), ["doc"])


_PLACE = f"list_position([{', '.join(repr(h) for h in L.TRACKED_HEADINGS)}], heading)"


@query(
    f"""{PAGES}, m AS (SELECT e.*, r.number AS hit FROM page_edges e LEFT JOIN register r ON e.ref_number = r.number AND r.id <> '' WHERE ref_number <> ''),
      official AS (SELECT doc, heading, string_agg(hit, ', ' ORDER BY o) AS v FROM (SELECT doc, heading, hit, min(ord) AS o FROM m WHERE hit IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2),
      gone AS (SELECT doc, string_agg(ref_number, ', ' ORDER BY o) AS v FROM (SELECT doc, ref_number, min(({_PLACE}, ord)) AS o FROM m
        WHERE hit IS NULL AND {_PLACE} > 0 GROUP BY 1, 2) GROUP BY 1),
      notes AS (SELECT doc, string_agg(line, e'\\n' ORDER BY o) AS v FROM (SELECT doc, heading || ' - ' || ref_number AS line, min(({_PLACE}, ord)) AS o FROM m
        WHERE {_PLACE} > 0 AND heading NOT IN ({OFFICIAL}) GROUP BY 1, 2) GROUP BY 1)
    SELECT page_id AS doc, coalesce((SELECT v FROM official o WHERE o.doc = page_id AND heading = 'Văn bản căn cứ'), '') AS basis,
      coalesce((SELECT v FROM official o WHERE o.doc = page_id AND heading = 'Văn bản được hướng dẫn'), '') AS guided_by,
      coalesce((SELECT v FROM official o WHERE o.doc = page_id AND heading = 'Văn bản bị sửa đổi, bổ sung'), '') AS amends,
      coalesce((SELECT v FROM official o WHERE o.doc = page_id AND heading = 'Văn bản sửa đổi, bổ sung'), '') AS amended_by,
      coalesce((SELECT v FROM gone g WHERE g.doc = page_id), '') AS not_in_register,
      concat_ws(e'\\n', CASE WHEN page_id % 2 = 0 THEN 'cũ' END, (SELECT v FROM notes n WHERE n.doc = page_id)) AS relation_note,
      CASE WHEN page_id % 3 = 0 THEN 'Cần xác nhận' ELSE 'Đã gợi ý' END AS relation_status FROM pages"""
)
def matched_payloads(spark, folder):
    k = F.col("page_id")
    payloads = table(spark, folder, "pages").select(
        k.alias("doc"), F.when(k % 2 == 0, " cũ ").otherwise("").alias("relation_note"), F.when(k % 3 == 0, "Cần xác nhận").otherwise("khác").alias("relation_status")
    )
    done = X.apply_match(payloads, page_edges(spark, folder), register(spark, folder), ["doc"])
    return done.select("doc", *L.OFFICIAL_COLUMNS, "not_in_register", "relation_note", "relation_status")


def _item_rows(spark, folder):
    """Links as two extractions of the same edges: even and odd places, some in both."""
    base = page_edges(spark, folder).filter("item <> ''")
    blocks = base.withColumn("heading", F.concat("heading", F.lit(" ("), F.col("ord").cast("string"), F.lit(")"))).select("doc", "ord", "heading", "item")
    shown = base.filter(F.length("item") >= 20).select("doc", "ord", "heading", "item")
    return X.block_edges(blocks, ["doc"]), shown


@query(
    f"""{PAGES}, b AS (SELECT DISTINCT doc, heading, item FROM page_edges), p AS (SELECT doc, heading, item FROM page_edges WHERE length(item) >= 20),
    both_ AS (SELECT doc, heading, item, 1 AS b, 0 AS p FROM b UNION ALL SELECT doc, heading, item, 0, 1 FROM p)
    SELECT doc, sum(b)::BIGINT AS from_blocks, sum(p)::BIGINT AS from_positions, count(DISTINCT (heading, item)) AS merged, sum(b) = 0 AND sum(p) > 0 AS fallback_only
    FROM both_ GROUP BY doc"""
)
def extraction_meta(spark, folder):
    blocks, shown = _item_rows(spark, folder)
    return X.extraction_meta(blocks, shown, ["doc"])


@query(
    f"""{PAGES}, m AS (SELECT doc, heading, item, 'blocks' AS source, ord FROM page_edges UNION ALL
      SELECT doc, heading, item, 'positions', ord FROM page_edges WHERE length(item) >= 20)
    SELECT doc, heading, item, ord, source FROM (SELECT *, row_number() OVER (PARTITION BY doc, heading, item ORDER BY source, ord) AS rn FROM m) WHERE rn = 1"""
)
def merged_edges(spark, folder):
    blocks, shown = _item_rows(spark, folder)
    return X.merge_edges(blocks, shown, ["doc"])


# --- headings and items on a page -------------------------------------------------------------
_ITEMS = f"""items AS (SELECT doc, ord, (ord * 13 % 97)::DOUBLE * 10 AS top, (length(item) * 37 % 900)::DOUBLE AS left_,
   CASE WHEN ord % 5 = 1 THEN heading ELSE item || ' 12/2020/TT-BTC' END AS text FROM page_edges)"""


def _items(spark, folder):
    rows = page_edges(spark, folder)
    return rows.select(
        "doc", "ord", ((F.col("ord") * 13 % 97).cast("double") * 10).alias("top"), (F.length("item") * 37 % 900).cast("double").alias("left"),
        F.when(F.col("ord") % 5 == 1, F.col("heading")).otherwise(F.concat("item", F.lit(" 12/2020/TT-BTC"))).alias("text"),
    )


@query(
    f"""{PAGES}, {_ITEMS}, heads AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, text ORDER BY ord) AS rn FROM items WHERE ord % 5 = 1) WHERE rn = 1),
    its AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, text, top ORDER BY ord) AS rn FROM items WHERE ord % 5 <> 1) WHERE rn = 1)
    SELECT i.doc, i.ord, i.text AS item, (SELECT arg_max(h.text, (h.top, h.left_, h.ord)) FROM heads h
      WHERE h.doc = i.doc AND h.top <= i.top AND abs(h.left_ - i.left_) <= 240) AS heading FROM its i
    WHERE EXISTS (SELECT 1 FROM heads h WHERE h.doc = i.doc AND h.top <= i.top AND abs(h.left_ - i.left_) <= 240)"""
)
def nearest_heading(spark, folder):
    items = staged(_items(spark, folder))  # read as items and as headings
    found = X.nearest_heading(X.item_candidates(items, ["doc"]), X.heading_candidates(items, ["doc"]), ["doc"], ["ord"])
    return found.select("doc", "ord", F.col("text").alias("item"), "heading")


@query(
    f"""WITH {SQL_LINKS} SELECT page_id, url, text, ord, score FROM (
      SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, length(text) DESC, ord) AS rn FROM (
        SELECT *, (CASE WHEN text IN ('In', 'Lưu', 'Chi tiết') THEN -3 ELSE 0 END) AS score FROM links)) WHERE rn = 1"""
)
def primary_links(spark, folder):
    return primary_link(links(spark, folder), ["page_id"]).select("page_id", "url", "text", "ord", "score")


@query(
    f"""WITH {SQL_LINKS} SELECT page_id, text, ord FROM (SELECT page_id, text, ord, row_number() OVER (PARTITION BY page_id ORDER BY length(text) DESC, ord) AS rn
      FROM links WHERE text <> '' AND text NOT IN ('In', 'Lưu', 'Chi tiết')) WHERE rn = 1"""
)
def fallback_titles(spark, folder):
    return fallback_title(links(spark, folder).select("page_id", "text", "ord"), ["page_id"])


@query(
    """SELECT text, doc_id, lang, source FROM (SELECT md5(text) AS text, doc_id, lang, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""
)
def dedup_first_documents(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "lang", "source", F.md5("text").alias("text"))
    return dedup_first(rows, ["text"], ["doc_id"])


@query(
    """SELECT source, lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) AS rn FROM documents) WHERE rn = 1"""
)
def dedup_longest_documents(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return dedup_longest(rows, ["source", "lang"], "text", ["doc_id"]).drop("text")


@query(f"""WITH {SQL_REGISTER} SELECT id AS matched_id, number AS matched_number, _row_number AS matched_row FROM register WHERE id <> ''""")
def register_index_rows(spark, folder):
    return register_index(register(spark, folder)).drop("match_key")


# --- lookups of spelled numbers -----------------------------------------------------------------
@query(f"""{WITH} SELECT doc, l1, l2, l3, l4, true AS is_duplicate FROM edges WHERE p IN (SELECT p FROM register)""")
def register_duplicates(spark, folder):
    rows = edges(spark, folder).withColumnRenamed("ref_number", "number")
    flagged = G.duplicate_flags(rows, register(spark, folder), EDGE_SPREAD)
    return flagged.filter("is_duplicate").select("doc", *EDGE_ORDER, "is_duplicate")


@query(
    f"""{WITH} SELECT doc, l1, l2, l3, l4, p + 2 AS target_row, CASE WHEN ref_number = {sql_number('p')} THEN 'exact' ELSE 'normalised' END AS matched_by
    FROM edges WHERE p IN (SELECT p FROM register)"""
)
def lookup_best(spark, folder):
    rows = edges(spark, folder).withColumnRenamed("ref_number", "number")
    return G.lookup_best(rows, register(spark, folder), EDGE_SPREAD).select("doc", *EDGE_ORDER, "target_row", "matched_by")


@query(
    f"""WITH {SQL_REGISTER} SELECT o_orderkey AS target_id, CASE WHEN o_orderkey + 2 IN (SELECT _row_number FROM register) THEN o_orderkey + 2
      WHEN o_custkey IN (SELECT p FROM register) THEN o_custkey + 2 END AS found_row FROM orders"""
)
def lookup_row_or_number(spark, folder):
    targets = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("target_id"), (F.col("o_orderkey") + 2).alias("target_row_number"), number_of(F.col("o_custkey")).alias("target_number")
    )
    return G.lookup_row_or_number(targets, register(spark, folder)).select("target_id", "found_row")


_KEY_SQL = "upper(replace(replace(replace(replace(strip_accents(replace(replace(ref_number, 'Đ', 'D'), 'đ', 'd')), ' ', ''), '-', ''), '–', ''), '.', ''))"


@query(f"""{WITH} SELECT {_KEY_SQL} AS match_key, {_TRACK_SQL} AS tracking_key, count(*) AS n FROM edges GROUP BY 1, 2""")
def number_keys(spark, folder):
    rows = edges(spark, folder).select(match_key("ref_number").alias("match_key"), tracking_key("ref_number").alias("tracking_key"))
    return rows.groupBy("match_key", "tracking_key").agg(F.count(F.lit(1)).alias("n"))


# --- runs over time -----------------------------------------------------------------------------
def _runs(spark, folder):
    """Users of each day of events as the missing keys of that day's run."""
    user = F.col("user_id").cast("string")
    return table(spark, folder, "events").select(F.col("ts").cast("date").alias("run"), user.alias("key"), F.concat(F.lit("U"), user).alias("number")).distinct()


def _delta(spark, folder):
    runs = _runs(spark, folder)
    return X.missing_deltas(runs, runs.select("run").distinct(), "run")


_DELTA = """days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
  delta AS (SELECT d, user_id, CASE WHEN bool_or(c) AND bool_or(p) THEN 'persistent' WHEN bool_or(c) THEN 'new' ELSE 'resolved' END AS state FROM (
    SELECT user_id, d, true AS c, false AS p FROM days UNION ALL SELECT user_id, d + 1, false, true FROM days) WHERE d IN (SELECT d FROM days) GROUP BY d, user_id)"""


@query(f"""WITH {_DELTA} SELECT d AS run, user_id::VARCHAR AS key, 'U' || user_id AS number, state FROM delta""")
def missing_delta(spark, folder):
    return _delta(spark, folder)


@query(
    f"""WITH {_DELTA} SELECT d AS run, count(*) FILTER (WHERE state <> 'resolved') AS current_missing, count(*) FILTER (WHERE state <> 'new') AS previous_missing,
      count(*) FILTER (WHERE state = 'new') AS new_missing, count(*) FILTER (WHERE state = 'resolved') AS resolved_missing,
      count(*) FILTER (WHERE state = 'persistent') AS persistent_missing,
      count(*) FILTER (WHERE state <> 'resolved') - count(*) FILTER (WHERE state <> 'new') AS net_delta FROM delta GROUP BY d"""
)
def missing_delta_summary(spark, folder):
    return X.delta_summary(_delta(spark, folder), ["run"])


@query(
    """WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events)
    SELECT strftime(d, '%Y-%m-%d') AS run_ts, count(*) FILTER (WHERE c) AS missing, count(*) FILTER (WHERE c AND NOT p) AS new,
      count(*) FILTER (WHERE p AND NOT c) AS resolved, count(*) FILTER (WHERE c AND p) AS persistent, count(*) FILTER (WHERE c) - count(*) FILTER (WHERE p) AS net
    FROM (SELECT user_id, d, bool_or(c) AS c, bool_or(p) AS p FROM (
        SELECT user_id, d, true AS c, false AS p FROM days UNION ALL SELECT user_id, d + 1, false, true FROM days) GROUP BY 1, 2)
    WHERE d IN (SELECT d FROM days) GROUP BY d"""
)
def run_history(spark, folder):
    """One history row per day, against the day before: all days go through the store of missing keys."""
    history = write_missing_snapshot(_runs(spark, folder), f"{shared_folder(spark)}/missing-{uuid.uuid4().hex}", "run")
    return history.select(
        "run_ts", F.col("current_missing").alias("missing"), F.col("new_missing").alias("new"), F.col("resolved_missing").alias("resolved"),
        F.col("persistent_missing").alias("persistent"), F.col("net_delta").alias("net"),
    )


@query(
    """SELECT n_nationkey, s.name AS region_label FROM (SELECT n_nationkey, lower(n_name) AS k FROM nation)
    LEFT JOIN (SELECT lower(n_name) AS k2, r_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey) s ON k = k2"""
)
def map_field(spark, folder):
    from vellum.operators.documents import map_field as mapped

    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    mapping = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.lower("n_name").alias("name"), F.col("r_name").alias("value"))
    return mapped(nations, mapping, "n_name", "region_label").select("n_nationkey", "region_label")


@query(
    f"""WITH {SQL_REGISTER}, vals AS (SELECT _row_number, trim(unnest(regexp_split_to_array(amends, '[\\n,;]+'))) AS v FROM register WHERE amends <> '')
    SELECT r._row_number, coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM vals WHERE vals._row_number = r._row_number AND v LIKE '%/TT-BTC'), '') AS written,
      coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM vals WHERE vals._row_number = r._row_number AND v NOT LIKE '%/TT-BTC'), '') AS skipped FROM register r"""
)
def allowed_values(spark, folder):
    rows = register(spark, folder).withColumn("_v", split_values("amends"))
    allowed = F.filter("_v", lambda v: F.endswith(v, F.lit("/TT-BTC")))
    return rows.select("_row_number", X.allowed_values(F.col("_v"), allowed).alias("a")).select(
        "_row_number", F.array_join(F.array_sort("a.written"), ",").alias("written"), F.array_join(F.array_sort("a.skipped"), ",").alias("skipped")
    )
