"""Readers on texts built of the given tables, sound and broken ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.plans.adapters import number_of, sql_number, table
from vellum.plans.registry import query
from vellum.sources import files as S
from vellum.sources.config import expand_fields, field_rows
from vellum.sources.quarantine import quarantined, readable


def _text(c: str):
    return F.col(c).cast("string")


def _broken(key, whole, wrong: str):
    """Every twelfth text of four kinds cannot be read."""
    kind = key % 12
    return F.when(kind == 3, '{"a":[').when(kind == 5, "[1]").when(kind == 7, " ").when(kind == 9, wrong).otherwise(whole)


# --- crawl results ----------------------------------------------------------------------------
def _listing_texts(spark, folder):
    k = F.col("page_id")
    doc = F.struct(
        F.concat(F.lit("f"), (k % 4).cast("string")).alias("ma_linh_vuc"), F.col("url"), F.concat(F.lit("T"), _text("page_id")).alias("title_from_list"),
        F.lit("Luật").alias("doc_type_from_list"), number_of(k).alias("doc_number_from_list"),
    )
    page = F.struct((k % 3 + 1).alias("page_index"), F.col("url"), F.lit(1).alias("document_count"))
    field = F.struct(
        F.concat(F.lit("f"), (k % 4).cast("string")).alias("ma_linh_vuc"), F.when(k % 2 == 0, "done").otherwise("stopped").alias("status"),
        F.array_repeat(doc, (k % 3).cast("int")).alias("documents"), F.array(page).alias("pages_crawled"), F.create_map(F.lit("input_links"), k).alias("filter_debug_stats"),
    )
    whole = F.to_json(F.struct(F.lit("all").alias("run_mode"), F.array(doc).alias("documents"), F.array(field).alias("fields")))
    return table(spark, folder, "pages").select("page_id", _broken(k, whole, '{"documents":"x","fields":[]}').alias("text"))


_READ = "page_id % 12 NOT IN (3, 5, 7, 9)"


@query(
    f"""SELECT page_id, 'document' AS part, url AS name, {sql_number('page_id')} AS more, 0::BIGINT AS n FROM pages WHERE {_READ}
      UNION ALL SELECT page_id, 'field', 'f' || page_id % 4, CASE WHEN page_id % 2 = 0 THEN 'done' ELSE 'stopped' END, page_id % 3 FROM pages WHERE {_READ}
      UNION ALL SELECT page_id, 'page', url, 'f' || page_id % 4, page_id % 3 + 1 FROM pages WHERE {_READ}"""
)
def listing_result(spark, folder):
    frames = S.shape_listing(readable(S.listing_rows(_listing_texts(spark, folder)), ["page_id"]), ["page_id"])
    row = lambda part, name, more, n: ("page_id", F.lit(part).alias("part"), F.col(name).alias("name"), F.col(more).alias("more"), n.cast("long").alias("n"))
    documents = frames["documents"].select(*row("document", "url", "doc_number", F.lit(0)))
    fields = frames["fields"].select(*row("field", "field_code", "status", F.col("document_count")))
    pages = frames["pages"].select(*row("page", "url", "field_code", F.col("page_index")))
    return documents.unionByName(fields).unionByName(pages)


def _debug_texts(spark, folder):
    k = F.col("page_id")
    page = F.struct(k.alias("page_index"), F.col("url"), F.lit("seen").alias("skipped_reason"), F.create_map(F.lit("wrong_type"), k % 7).alias("filter_rejections"))
    field = F.struct(F.concat(F.lit("f"), (k % 4).cast("string")).alias("ma_linh_vuc"), F.array_repeat(page, (k % 3).cast("int")).alias("debug_pages"))
    whole = F.to_json(F.struct(F.array(field).alias("fields")))
    return table(spark, folder, "pages").select("page_id", _broken(k, whole, '{"fields":{"a":1}}').alias("text"))


@query(
    f"""SELECT page_id, 'f' || page_id % 4 AS field_code, url, page_id % 7 AS wrong_type FROM pages, range(0, 3) r(i) WHERE i < page_id % 3 AND {_READ}"""
)
def listing_debug(spark, folder):
    pages = S.shape_listing_debug(readable(S.listing_debug_rows(_debug_texts(spark, folder)), ["page_id"]), ["page_id"])
    return pages.select("page_id", "field_code", "url", F.col("filter_rejections")["wrong_type"].alias("wrong_type"))


# --- submissions ------------------------------------------------------------------------------
def _batch_texts(spark, folder):
    k = F.col("o_orderkey")
    payload = F.struct(number_of(k).alias("Số hiệu"), F.concat(F.lit("V"), _text("o_orderkey")).alias("Tên văn bản"), F.lit("z").alias("unknown"))
    result = F.struct(
        F.concat(F.lit("u"), _text("o_orderkey")).alias("url"), F.when(k % 5 == 0, "error").otherwise("sent").alias("status"),
        F.struct((k % 5 != 0).alias("ok")).alias("result"), (k % 3 + 1).alias("send_attempt"),
    )
    whole = F.to_json(F.struct((k % 2 == 0).alias("dry_run"), F.array(payload).alias("payloads"), F.array(result).alias("results")))
    return table(spark, folder, "orders").select("o_orderkey", _broken(k, whole, '{"payloads":[{"Số hiệu":"1"}],"results":7}').alias("text"))


_READ_ORDERS = "o_orderkey % 12 NOT IN (3, 5, 7, 9)"


@query(
    f"""SELECT o_orderkey, {sql_number('o_orderkey')} AS number, 'V' || o_orderkey AS title, CASE WHEN o_orderkey % 5 = 0 THEN 'error' ELSE 'sent' END AS status,
      CASE WHEN o_orderkey % 5 = 0 THEN '{{"ok":false}}' ELSE '{{"ok":true}}' END AS result, (o_orderkey % 3 + 1)::INT AS send_attempt, o_orderkey % 2 = 0 AS dry_run FROM orders WHERE {_READ_ORDERS}"""
)
def payload_batch(spark, folder):
    frames = S.shape_batch(readable(S.batch_rows(_batch_texts(spark, folder)), ["o_orderkey"]), ["o_orderkey"])
    payloads = frames["payloads"].select("o_orderkey", "number", "title")
    return payloads.join(frames["results"].select("o_orderkey", "status", "result", "send_attempt", "dry_run"), "o_orderkey")


# --- register sheet and snapshot lines ----------------------------------------------------------
_HEADER = ["_rowNumber", "Số hiệu", "Tên văn bản", "other"]


def _sheet_lines(spark, folder):
    k = F.col("p_partkey")
    row = F.when(k % 11 == 4, "none").otherwise(_text("p_partkey"))
    title = F.when(k % 3 == 0, F.concat(F.lit('"a ""'), _text("p_partkey"), F.lit('"", b"'))).otherwise(F.lit(""))
    whole = F.concat_ws(",", row, number_of(k), title, F.lit("z"))
    line = F.when(k % 10 == 6, F.concat(_text("p_partkey"), F.lit(",x"))).when(k % 10 == 8, "  ").otherwise(whole)
    return table(spark, folder, "part").select("p_partkey", line.alias("text"))


@query(
    f"""SELECT p_partkey AS _row_number, {sql_number('p_partkey')} AS number, CASE WHEN p_partkey % 3 = 0 THEN 'a "' || p_partkey || '", b' ELSE '' END AS title, '' AS topic
      FROM part WHERE p_partkey % 10 NOT IN (6, 8) AND p_partkey % 11 <> 4"""
)
def register_lines(spark, folder):
    rows = readable(S.register_rows(_sheet_lines(spark, folder), _HEADER), [])
    return S.shape_register(rows, ["number", "title", "topic"])


def _snapshot_lines(spark, folder):
    k = F.col("p_partkey")
    key = F.when(k % 5 != 2, F.concat(F.lit("K"), _text("p_partkey")))
    whole = F.to_json(F.struct(key.alias("key"), number_of(k).alias("number"), (k % 9).alias("count"), F.array(F.lit("h")).alias("headings")))
    return table(spark, folder, "part").select("p_partkey", _broken(k, whole, '{"key":"K","count":"many"}').alias("text"))


@query(
    f"""SELECT 'K' || p_partkey AS key, {sql_number('p_partkey')} AS number, p_partkey % 9 AS "count", 'h' AS heading FROM part
      WHERE p_partkey % 12 NOT IN (3, 5, 7, 9) AND p_partkey % 5 <> 2"""
)
def snapshot_lines(spark, folder):
    rows = readable(S.snapshot_rows(_snapshot_lines(spark, folder)), [])
    return rows.select("key", "number", "count", F.col("headings")[0].alias("heading"))


# --- rule files -----------------------------------------------------------------------------------
@query(
    """WITH f AS (SELECT s_suppkey AS k, unnest(range(0, CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 2 END)) AS i FROM supplier WHERE s_suppkey % 6 <> 5),
      e AS (SELECT k, i, 'https://list.example.org/a.html?n=' || k AS u, CASE WHEN (k + i) % 3 = 0 THEN ['21', '11'] ELSE ['10'] END AS ids FROM f WHERE (k + i) % 5 <> 0)
    SELECT k AS s_suppkey, i::INT AS ord, CASE WHEN k % 2 = 0 THEN 'a|b' ELSE 'a' END AS codes, d AS crawl_doc_type_id, u || '&DocTypeId=' || d AS list_url FROM (SELECT *, unnest(ids) AS d FROM e)"""
)
def field_entries(spark, folder):
    """Rule files from the suppliers: a list of fields, or one field; some are no JSON."""
    k = F.col("s_suppkey")

    def entry(i: int):
        n = k + i
        ids = F.when(n % 3 == 0, F.array(F.lit("21"), F.lit("11")))
        codes = F.when(k % 2 == 0, F.to_json(F.array(F.lit("a"), F.lit("b")))).otherwise('"a"')
        filters = F.to_json(F.struct(ids.alias("doc_type_ids_to_crawl"), F.array(F.lit(" Luật "), F.lit("Công văn")).alias("accepted_doc_types")))
        enabled = F.when(n % 5 != 0, "true").when(k % 2 == 0, "false").otherwise('"true"')
        url = F.concat(F.lit("https://list.example.org/a.html?n="), _text("s_suppkey"))
        return F.concat(F.lit('{"enabled":'), enabled, F.lit(',"ma_linh_vuc":'), codes, F.lit(',"list_url":"'), url, F.lit('","filters":'), filters, F.lit("}"))

    listed = F.concat(F.lit('{"fields":['), entry(0), F.lit(","), entry(1), F.lit(',"x"]}'))
    text = F.when(k % 6 == 5, '{"fields":[').when(k % 4 == 0, entry(0)).otherwise(listed)
    rows = field_rows(table(spark, folder, "supplier").select("s_suppkey", text.alias("text")), ["s_suppkey"])
    return expand_fields(rows).select("s_suppkey", "ord", F.array_join("field_codes", "|").alias("codes"), "crawl_doc_type_id", "list_url")


# --- what cannot be read ------------------------------------------------------------------------
def _faults(name: str, key: str, table_name: str, wrong: str) -> str:
    return f"""SELECT '{name}' AS reader, {key} AS id, CASE {key} % 12 WHEN 3 THEN 'not JSON' WHEN 5 THEN 'not an object' WHEN 7 THEN 'blank' ELSE '{wrong}' END AS reason
      FROM {table_name} WHERE {key} % 12 IN (3, 5, 7, 9)"""


@query(
    " UNION ALL ".join(
        [
            _faults("listing", "page_id", "pages", "wrong type: documents"), _faults("debug", "page_id", "pages", "wrong type: fields"),
            _faults("batch", "o_orderkey", "orders", "wrong type: results"), _faults("snapshot", "p_partkey", "part", "wrong type: count"),
            "SELECT 'snapshot', p_partkey, 'no key' FROM part WHERE p_partkey % 12 NOT IN (3, 5, 7, 9) AND p_partkey % 5 = 2",
            """SELECT 'register', p_partkey, CASE WHEN p_partkey % 10 = 6 THEN 'cells do not match the header' WHEN p_partkey % 10 = 8 THEN 'blank' ELSE 'no row number' END
              FROM part WHERE p_partkey % 10 IN (6, 8) OR p_partkey % 11 = 4""",
        ]
    )
)
def quarantine(spark, folder):
    """Every text that a reader leaves out, once, with the reason."""
    read = [
        ("listing", "page_id", S.listing_rows(_listing_texts(spark, folder))), ("debug", "page_id", S.listing_debug_rows(_debug_texts(spark, folder))),
        ("batch", "o_orderkey", S.batch_rows(_batch_texts(spark, folder))), ("snapshot", "p_partkey", S.snapshot_rows(_snapshot_lines(spark, folder))),
        ("register", "p_partkey", S.register_rows(_sheet_lines(spark, folder), _HEADER)),
    ]
    frames = [quarantined(rows, [F.lit(name).alias("reader"), F.col(key).cast("long").alias("id")]).drop("text") for name, key, rows in read]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
