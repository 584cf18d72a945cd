"""Text reports as ordered lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum import labels as L
from vellum.operators import relations as X
from vellum.operators import validation as V
from vellum.operators.report_lines import LAST, WIDTH, listing_report, run_report
from vellum.operators.report_lines import report_lines as lines_of
from vellum.plans.adapters import edges, links, number_of, register, sql_number, table
from vellum.plans.register_queries import _RESULTS, _results
from vellum.plans.registry import CHECKS, query
from vellum.plans.relation_queries import _rollup

TITLE = "RUN 1998-06-01"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _fixed(section: int, texts: list[str], start: int = 0) -> str:
    return " UNION ALL ".join(f"SELECT {section} AS section, {start + i}::BIGINT AS ord, {_literal(t)} AS line" for i, t in enumerate(texts))


def _items(section: int, source: str, lines: list[str]) -> str:
    """``source`` gives ``n`` and the columns of the lines."""
    return " UNION ALL ".join(f"SELECT {section}, n * {WIDTH} + {i}, {line} FROM ({source})" for i, line in enumerate(lines))


def _run_report_sql() -> str:
    t, rule = L.REPORT_TEXTS, L.REPORT_DASHES
    ranked = "SELECT *, row_number() OVER (ORDER BY ord) AS n FROM (SELECT sev.*, status FROM sev JOIN res USING (ord)) WHERE {0} QUALIFY n <= 40"
    share = "cov.coverage_percent || '% (' || matched || ' matched / ' || total"
    per = "SELECT *, row_number() OVER (ORDER BY heading) AS n FROM cov WHERE is_total = 0"
    top = "SELECT *, row_number() OVER (ORDER BY \"count\" DESC, number) AS n FROM top_"
    verdict = "SELECT unnest(string_split({0}, '|')) AS text, generate_subscripts(string_split({0}, '|'), 1) AS n FROM verdict"
    parts = [
        _fixed(1, [L.REPORT_RULE, TITLE, L.REPORT_RULE]),
        f"SELECT 1, {WIDTH}, {_literal(t['created'] + '1998-06-01')} UNION ALL SELECT 1, {WIDTH + 1}, {_literal(t['verdict'] + L.REPORT_NOT_OK)} UNION ALL SELECT 1, {WIDTH + 2}, ''",
        _fixed(2, [t["config"], rule, ""]), _fixed(3, ["", "STEP07", rule]), _fixed(4, ["", "STEP08", rule]),
        _fixed(5, ["STEP08 - Result lỗi:"]), _items(5, ranked.format("severity = 'error'"), ["'- URL: U' || ord", "'  Status: ' || status", "'  Error: ' || outcome"]), _fixed(5, [""], LAST),
        _fixed(6, ["STEP08 - Quan hệ pháp lý chưa có trong danh mục:"]), _items(6, ranked.format("missing_relations > 0"), ["'- URL: U' || ord", "'  Missing relationships: ' || missing_relations"]),
        _fixed(6, [""], LAST), _fixed(7, [t["production"], rule]),
        _items(8, "SELECT *, 1 AS n FROM cov WHERE is_total = 1", [f"'Match coverage: ' || {share.replace('cov.', '')} || ' total relationships)'", "'Missing relationships: ' || missing", "''"]),
        _fixed(9, [t["by_heading"]]), _items(9, per, [f"'- ' || heading || ': ' || {share.replace('cov.', '')} || ' total, ' || missing || ' missing)'"]), _fixed(9, [""], LAST),
        _fixed(10, [t["top_missing"]]), _items(10, top, ["n || '. ' || number || ' | thiếu ' || \"count\" || ' lần | nhóm: ' || replace(headings, '|', ', ')", "'   Ví dụ: ' || substr(split_part(examples, '|', 1), 1, 250)"]),
        _fixed(10, [""], LAST), _fixed(11, [t["conclusion"], rule]),
        _fixed(12, [t["errors"]]), _items(12, verdict.format("errors"), ["'- ' || text"]), _fixed(13, ["", t["warnings"]]), _items(13, verdict.format("warnings"), ["'- ' || text"]),
        _fixed(14, ["", L.REPORT_RULE, TITLE, L.REPORT_RULE]),
    ]
    rollup = CHECKS["missing_rollup"]
    return f"""WITH {_RESULTS}, cov AS ({CHECKS['match_coverage']}), verdict AS ({CHECKS['run_verdict']}),
      top_ AS (SELECT * FROM ({rollup}) ORDER BY "count" DESC, number LIMIT 20) {' UNION ALL '.join(parts)}"""


@query(_run_report_sql())
def report_lines(spark, folder):
    """The run report of the orders' results, with coverage, missing references and verdict."""
    judged = V.result_outcome(_results(spark, folder)).withColumns(
        {"url": F.concat(F.lit("U"), F.col("ord").cast("string")), "error": F.col("outcome"), "message": F.lit(None), "response": F.lit(None)}
    )
    counts = V.result_counts(judged)
    zero = F.lit(0)
    verdict = V.run_verdict(counts.withColumns({"config_errors": zero, "documents": F.col("results"), "invalid_documents": zero, "invalid_payloads": zero, "warned_documents": zero}))
    texts = lambda c: verdict.select(F.posexplode(c).alias("ord", "text"))
    frames = {
        "run": verdict.select(F.lit("1998-06-01").alias("created_at"), "ok"),
        "result_error": judged.filter("severity = 'error'"), "relation_missing": judged.filter("missing_relations > 0"),
        "coverage": X.match_coverage(edges(spark, folder), register(spark, folder)), "top_missing": X.top_missing(_rollup(spark, folder)),
        "errors": texts("errors"), "warnings": texts("warnings"),
    }
    return lines_of(spark, run_report(spark, TITLE, frames))


_DOCS = "SELECT *, page_id % 5 AS branch, row_number() OVER (PARTITION BY page_id % 5 ORDER BY page_id, ord) AS n FROM links"


def _listing_sql() -> str:
    t = L.LISTING_TEXTS
    field = ["'F' || branch", "branch", "'done'", "0", "pages", "docs"]
    labels = [L.LISTING_DASHES, *[label for _, label in t["field"]], "", t["pages"], L.LISTING_DASHES]
    values = ["''", *field, "''", "''", "''"]
    own = " UNION ALL ".join(f"SELECT branch * 3 + 1, {i}, {_literal(text)} || {value} FROM f" for i, (text, value) in enumerate(zip(labels, values)))
    run = [f"'{L.LISTING_RULE}'", _literal(TITLE), f"'{L.LISTING_RULE}'", "''"]
    run += [f"{_literal(label)} || {value}" for (_, label), value in zip(t["run"], ["'1998-06-01'", "'all'", "(SELECT count(*) FROM f)", "(SELECT count(*) FROM d)"])] + ["''"]
    head = " UNION ALL ".join(f"SELECT 0::BIGINT AS section, {i}::BIGINT AS ord, {text} AS line" for i, text in enumerate(run))
    pages = ["'Trang ' || page_id || ': 1 URL, ' || page_id % 2 || ' URL mới, lũy kế ' || page_id", "'URL: ' || url", "''"]
    listed = " UNION ALL ".join(f"SELECT page_id % 5 * 3 + 2, page_id * {WIDTH} + {i}, {text} FROM pages" for i, text in enumerate(pages))
    document = [f"n || '. ' || CASE WHEN text = '' THEN {_literal(t['untitled'])} ELSE text END", "'   Loại nhận diện: '", f"'   Số hiệu nhận diện: ' || {sql_number('ord')}", "'   Trang nguồn: ' || page_id", "'   URL: ' || url", "''"]
    docs = " UNION ALL ".join(f"SELECT branch * 3 + 3, n * {WIDTH} + {i}, {text} FROM d" for i, text in enumerate(document))
    heads = " UNION ALL ".join(f"SELECT branch * 3 + 3, {i}, {_literal(text)} FROM f" for i, text in enumerate([t["documents"], L.LISTING_DASHES]))
    links_sql = CHECKS["page_links"]
    return f"""WITH links AS ({links_sql}), d AS ({_DOCS}),
      f AS (SELECT branch, pages, coalesce(docs, 0) AS docs FROM (SELECT page_id % 5 AS branch, count(*) AS pages FROM pages GROUP BY 1)
        LEFT JOIN (SELECT branch, count(*) AS docs FROM d GROUP BY 1) USING (branch))
      {' UNION ALL '.join([head, own, listed, heads, docs])}"""


@query(_listing_sql())
def listing_lines(spark, folder):
    """The pages' links as a crawl result of five fields, in readable form."""
    branch = (F.col("page_id") % 5).alias("branch")
    found = links(spark, folder)
    documents = found.select(
        branch, (F.col("page_id") * 1_000_000 + F.col("ord")).alias("ord"), F.col("text").alias("title"), F.lit("").alias("doc_type"),
        number_of(F.col("ord")).alias("doc_number"), F.col("page_id").alias("page_index"), "url",
    )
    k = F.col("page_id")
    pages = table(spark, folder, "pages").select(
        branch, k.alias("page_index"), F.lit(1).alias("document_count"), (k % 2).alias("new_document_count"), k.alias("total_documents_so_far"), "url"
    )
    counts = documents.groupBy("branch").agg(F.count(F.lit(1)).alias("document_count"))
    fields = pages.groupBy("branch").agg(F.count(F.lit(1)).alias("page_count")).join(counts, "branch", "left").select(
        "branch", F.concat(F.lit("F"), F.col("branch").cast("string")).alias("field_name"), F.col("branch").cast("string").alias("field_code"),
        F.lit("done").alias("status"), F.lit(0).alias("announced"), "page_count", F.coalesce("document_count", F.lit(0)).alias("document_count"),
    )
    run = fields.agg(F.count(F.lit(1)).alias("fields"), F.sum("document_count").alias("documents")).withColumns({"created_at": F.lit("1998-06-01"), "run_mode": F.lit("all")})
    return listing_report(spark, TITLE, run, fields, pages, documents)
