"""Lines of text reports: ``(section, ord, line)`` from several frames, numbered without one task for all."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.operators.skew import position
from vellum.operators.validation import SECTION_CAPS
from vellum.sources.staging import staged

#: Order numbers: head lines from 0, an item's lines from its rank times ``WIDTH``, tail lines from ``LAST``.
WIDTH, LAST = 100, 2**62


@dataclass
class Block:
    """One section: ``head`` lines, the ``lines`` of each row of ``rows``, ``tail`` lines.

    Rows come in ``order``; only ``cap`` of them, if given. Without a cap ``order`` must be one column of
    whole numbers without repeats, which is numbered in chunks. A line may use the row's rank ``n``; NULL lines
    are left out. Head and tail are there if a row is, or ``always``; ``otherwise`` stands in for no rows.
    """

    rows: DataFrame | None = None
    lines: list = field(default_factory=list)
    order: list = field(default_factory=list)
    head: list[str] = field(default_factory=list)
    tail: list[str] = field(default_factory=list)
    cap: int | None = None
    always: bool = False
    otherwise: str | None = None


def _fixed(spark: SparkSession, section: int, texts: list[str], start: int) -> DataFrame:
    return spark.createDataFrame([(section, start + i, t) for i, t in enumerate(texts)], "section int, ord long, line string")


def _ranked(block: Block) -> DataFrame:
    if block.cap is None:
        return position(block.rows, [], block.order[0], "n")
    first = block.rows.orderBy(*block.order).limit(block.cap)
    return first.withColumn("n", F.row_number().over(Window.orderBy(*block.order)).cast("long"))  # at most ``cap`` rows


def _block_lines(spark: SparkSession, section: int, block: Block) -> list[DataFrame]:
    head, tail = (0, block.head), (LAST, block.tail)
    if block.rows is None:
        return [_fixed(spark, section, texts, start) for start, texts in (head, tail) if texts]
    ranked = staged(_ranked(block))  # head, lines and tail read it
    texts = F.array_compact(F.array(*block.lines))
    out = [ranked.select(F.lit(section).alias("section"), "n", F.posexplode(texts).alias("_p", "line")).select("section", (F.col("n") * WIDTH + F.col("_p")).alias("ord"), "line")]
    for start, fixed in (head, tail):
        if fixed and block.always:
            out.append(_fixed(spark, section, fixed, start))
        elif fixed:
            lines = F.posexplode(F.array(*[F.lit(t) for t in fixed])).alias("_p", "line")
            out.append(ranked.filter("n = 1").select(F.lit(section).alias("section"), lines).select("section", (F.col("_p") + F.lit(start)).cast("long").alias("ord"), "line"))
    if block.otherwise is not None:
        none = ranked.agg(F.count(F.lit(1)).alias("c")).filter("c = 0")
        out.append(none.select(F.lit(section).alias("section"), F.lit(WIDTH).cast("long").alias("ord"), F.lit(block.otherwise).alias("line")))
    return out


def report_lines(spark: SparkSession, blocks: list[Block]) -> DataFrame:
    """All lines of a report; sections are numbered from 1 in the order of the blocks."""
    parts = [p for n, b in enumerate(blocks, 1) for p in _block_lines(spark, n, b)]
    return reduce(DataFrame.unionByName, parts)


def _line(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def run_report(spark: SparkSession, title: str, frames: dict[str, DataFrame]) -> list[Block]:
    """The sections of the run report, in order.

    ``frames``: ``run`` (one row: created_at, ok), ``config_errors`` and ``config_warnings`` (code, message),
    ``STEP07`` and ``STEP08`` (ord, label, value), the lists of ``labels.REPORT_LISTS`` (ord and their columns),
    ``coverage``, ``delta``, ``new_missing``, ``top_missing``, ``errors`` and ``warnings`` (ord, text). What is not given
    is left out; the headers, that of the production section too, always stand.
    """
    t, rule = L.REPORT_TEXTS, L.REPORT_DASHES
    c = F.col
    verdict = F.when(c("ok"), L.REPORT_OK).otherwise(L.REPORT_NOT_OK)
    blocks = [
        Block(frames["run"], [_line(t["created"], c("created_at")), _line(t["verdict"], verdict), F.lit("")], ["created_at"], [L.REPORT_RULE, title, L.REPORT_RULE], cap=1, always=True),
        Block(head=[t["config"], rule, ""]),
    ]
    issue = [_line("- [", c("code"), "] ", c("message"))]
    if "config_errors" in frames:
        blocks.append(Block(frames["config_errors"], issue, ["code", "message"], [t["config_errors"]], cap=SECTION_CAPS["invalid"], otherwise=t["config_none"]))
    if "config_warnings" in frames:
        blocks.append(Block(frames["config_warnings"], issue, ["code", "message"], ["", t["config_warnings"]], cap=SECTION_CAPS["warning"]))
    for step in ("STEP07", "STEP08"):
        blocks.append(Block(head=["", step, rule]))
        if step in frames:
            blocks.append(Block(frames[step], [_line(c("label"), ": ", c("value"))], ["ord"], tail=[""], cap=WIDTH))
        for name, own, heading, lines in L.REPORT_LISTS:
            if own == step and name in frames:
                texts = [F.when(c(column).isNotNull(), _line(label, c(column))) for label, column in lines]
                blocks.append(Block(frames[name], texts, ["ord"], [heading], [""], SECTION_CAPS.get(name, SECTION_CAPS["invalid"])))
    blocks.append(Block(head=[t["production"], rule]))
    if "coverage" in frames:
        share = [c("coverage_percent"), "% (", c("matched"), " matched / ", c("total")]
        whole = frames["coverage"].filter("is_total = 1")
        blocks.append(Block(whole, [_line("Match coverage: ", *share, " total relationships)"), _line("Missing relationships: ", c("missing")), F.lit("")], ["total"], cap=1))
        per = frames["coverage"].filter("is_total = 0")
        blocks.append(Block(per, [_line("- ", c("heading"), ": ", *share, " total, ", c("missing"), " missing)")], ["heading"], [t["by_heading"]], [""], WIDTH))
    if "delta" in frames:
        blocks.append(Block(frames["delta"], [_line(before, c(name), after) for name, before, after in L.REPORT_DELTA], ["current_missing"], [t["delta"]], [""], 1))
    headings = F.array_join("headings", ", ")
    if "new_missing" in frames:
        blocks.append(Block(frames["new_missing"], [_line("- ", c("number"), " | xuất hiện ", c("count"), " lần | nhóm: ", headings)], ["key"], [t["new_missing"]], [""], SECTION_CAPS["new_missing"]))
    if "top_missing" in frames:
        example = F.when(F.size("examples") > 0, _line("   Ví dụ: ", F.substring(F.get("examples", F.lit(0)), 1, 250)))
        item = _line(c("n"), ". ", c("number"), " | thiếu ", c("count"), " lần | nhóm: ", headings)
        blocks.append(Block(frames["top_missing"], [item, example], [F.desc("count"), "number"], [t["top_missing"]], [""], 20))
    blocks.append(Block(head=[t["conclusion"], rule]))
    for name, heading, otherwise in (("errors", [t["errors"]], t["no_errors"]), ("warnings", ["", t["warnings"]], None)):
        if name in frames:
            blocks.append(Block(frames[name], [_line("- ", c("text"))], ["ord"], heading, cap=WIDTH, otherwise=otherwise))
    blocks.append(Block(head=["", L.REPORT_RULE, title, L.REPORT_RULE]))
    return blocks


def listing_report(spark: SparkSession, title: str, run: DataFrame, fields: DataFrame, pages: DataFrame, documents: DataFrame) -> DataFrame:
    """The readable listing ``(section, ord, line)``: every field with its pages and all its documents.

    ``fields``, ``pages`` and ``documents`` carry ``branch``; documents are numbered by ``ord`` inside their branch, in chunks.
    Section 0 is the head; a branch's lines are in sections ``3 * branch + 1`` to ``3 * branch + 3``.
    """
    t, c = L.LISTING_TEXTS, F.col
    head = F.array(F.lit(L.LISTING_RULE), F.lit(title), F.lit(L.LISTING_RULE), F.lit(""), *[_line(label, c(name)) for name, label in t["run"]], F.lit(""))

    def lines(rows: DataFrame, section: Column, start: Column, texts: Column) -> DataFrame:
        placed = rows.select(section.cast("long").alias("section"), start.cast("long").alias("_s"), F.posexplode(F.array_compact(texts)).alias("_p", "line"))
        return placed.select("section", (c("_s") + c("_p")).alias("ord"), "line")

    field_lines = F.array(F.lit(L.LISTING_DASHES), *[_line(label, c(name)) for name, label in t["field"]], F.lit(""), F.lit(t["pages"]), F.lit(L.LISTING_DASHES))
    counts = [c("document_count"), " URL, ", c("new_document_count"), " URL mới, lũy kế ", c("total_documents_so_far")]
    page_lines = F.array(_line("Trang ", c("page_index"), ": ", *counts), _line("URL: ", c("url")), F.lit(""))
    name = F.when(F.coalesce(c("title"), F.lit("")) == "", t["untitled"]).otherwise(c("title"))
    document_lines = F.array(_line(c("_n"), ". ", name), *[_line(label, c(col)) for col, label in t["document"]], F.lit(""))
    numbered = position(documents, ["branch"], "ord", "_n")
    return reduce(
        DataFrame.unionByName,
        [
            lines(run, F.lit(0), F.lit(0), head),
            lines(fields, c("branch") * 3 + 1, F.lit(0), field_lines),
            lines(pages, c("branch") * 3 + 2, c("page_index") * WIDTH, page_lines),
            lines(fields, c("branch") * 3 + 3, F.lit(0), F.array(F.lit(t["documents"]), F.lit(L.LISTING_DASHES))),
            lines(numbered, c("branch") * 3 + 3, c("_n") * WIDTH, document_lines),
        ],
    )
