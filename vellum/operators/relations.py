"""Relationship edges: extraction, register match, missing references, reverse links, cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import (
    canonical_heading, clean_text, is_heading, is_noise, is_relation_item, match_key, normalize_text,
    percent, primary_number, relation_status, split_values, tracking_key, unique_list,
)
from vellum.operators.dedup import register_index
from vellum.operators.skew import first_by, first_n_by, key_counts, lookup_join

MAX_DX = 240


# --- edges from page items ---------------------------------------------------------------
def block_edges(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Edges from heading blocks: counters dropped, only "document …" headings, first of equals."""
    rows = blocks.select(
        *page, "ord",
        normalize_text(F.regexp_replace(F.coalesce("heading", F.lit("")), r"\(\d+\)", "")).alias("heading"),
        normalize_text("item").alias("item"),
    ).filter((F.col("item") != "") & F.startswith(F.lower("heading"), F.lit(L.HEADING_PREFIX)))
    return first_by(rows, [*page, "heading", "item"], ["ord"])


def heading_candidates(items: DataFrame, page: list[str]) -> DataFrame:
    """Known heading texts of a page, the first item of each."""
    named = items.withColumn("text", normalize_text("text")).filter(is_heading("text"))
    return first_by(named, [*page, "text"], ["ord"])


def item_candidates(items: DataFrame, page: list[str]) -> DataFrame:
    """Items that read like a reference; one per text and whole-pixel top."""
    named = items.withColumn("text", normalize_text("text")).filter(is_relation_item("text"))
    rows = named.withColumn("_top", F.coalesce(F.col("top"), F.lit(0.0)).cast("long"))
    return first_by(rows, [*page, "text", "_top"], ["ord"]).drop("_top")


def nearest_heading(items: DataFrame, headings: DataFrame, page: list[str], spread: list[str], max_dx: float = MAX_DX) -> DataFrame:
    """As-of join: the last heading at or above the item and within ``max_dx`` sideways.

    Headings are one per known text, so a page has a small fixed number of them; they
    travel as one array per page and each item picks from it.  No pair of page items is
    ever formed and pages with many items are split like any heavy key.
    Of headings at the same height the one later in ``(left, ord)`` order counts.
    """
    entry = F.struct(F.col("top").alias("t"), F.col("left").alias("l"), F.col("ord").alias("o"), F.col("text").alias("x"))
    lists = headings.groupBy(*page).agg(F.collect_list(entry).alias("_headings"))
    joined = lookup_join(items, lists, page, spread)
    reach = F.filter(
        "_headings", lambda h: (h["t"] <= F.col("top")) & (F.abs(h["l"] - F.col("left")) <= max_dx)
    )
    best = F.array_max(reach)
    return joined.withColumn("heading", best["x"]).drop("_headings").filter("heading is not null")


def merge_edges(blocks: DataFrame, positions: DataFrame, page: list[str]) -> DataFrame:
    """Both extractions, block edges first; first of equal (heading, item)."""
    rows = blocks.select(*page, "heading", "item", "ord").withColumn("source", F.lit("blocks")).unionByName(
        positions.select(*page, "heading", "item", "ord").withColumn("source", F.lit("positions"))
    )
    return first_by(rows.filter("heading <> '' and item <> ''"), [*page, "heading", "item"], ["source", "ord"])


def extraction_meta(blocks: DataFrame, positions: DataFrame, page: list[str]) -> DataFrame:
    """Edges per source, merged number, and whether only the positional source gave any."""
    rows = blocks.select(*page, "heading", "item").withColumn("source", F.lit("blocks")).unionByName(
        positions.select(*page, "heading", "item").withColumn("source", F.lit("positions"))
    )
    edges = rows.groupBy(*page, "heading", "item").agg(
        F.count_if(F.col("source") == "blocks").alias("_b"), F.count_if(F.col("source") == "positions").alias("_p")
    )
    counted = edges.groupBy(*page).agg(
        F.sum("_b").alias("from_blocks"), F.sum("_p").alias("from_positions"), F.count(F.lit(1)).alias("merged")
    )
    return counted.withColumn("fallback_only", (F.col("from_blocks") == 0) & (F.col("from_positions") > 0))


def typed_edges(edges: DataFrame) -> DataFrame:
    """Headings settled to their known names and the primary number read from each item."""
    return edges.withColumn("heading", canonical_heading("heading")).withColumn("ref_number", primary_number("item"))


# --- match against the register -----------------------------------------------------------
def match_references(edges: DataFrame, register: DataFrame, spread: list[str]) -> DataFrame:
    """Each edge with the register row of its number, or NULLs.

    Every distinct spelling is keyed and matched once; the edges then take the answer by
    their spelling, rows of heavily cited ones split.
    """
    return lookup_join(edges, resolve_numbers(edges, register), ["ref_number"], spread).withColumn(
        "is_matched", F.col("matched_id").isNotNull()
    )


def resolve_numbers(edges: DataFrame, register: DataFrame) -> DataFrame:
    """Distinct spellings with key and register row (NULL when there is none)."""
    spellings = key_counts(edges, ["ref_number"]).select("ref_number", match_key("ref_number").alias("match_key"))
    return spellings.join(register_index(register), "match_key", "left")


def reference_counts(edges: DataFrame, register: DataFrame, by: list[str]) -> DataFrame:
    """Edges per (``by``, key), matched once per key: for reports that only count.

    Counting by spelling before keys are built and joined leaves one row per spelling and
    group, so no key is heavy and the key expression runs once per spelling.
    """
    named = edges.filter(clean_text("ref_number") != "").groupBy(*by, "ref_number").agg(F.count(F.lit(1)).alias("_n"))
    counts = named.groupBy(*by, match_key("ref_number").alias("match_key")).agg(F.sum("_n").alias("n"))
    return counts.join(register_index(register), "match_key", "left")


def missing_references(edges: DataFrame, register: DataFrame, doc: list[str], order: list[str], headings: list[str] | None = None) -> DataFrame:
    """Numbers of tracked headings without a register row, once per document.

    Distinct first, then an anti join on the key; ``first_ord`` gives first-seen order.
    """
    tracked = edges.filter(F.col("heading").isin(headings or L.TRACKED_HEADINGS)).withColumn("number", clean_text("ref_number"))
    distinct = tracked.filter("number <> ''").groupBy(*doc, "number").agg(F.min(F.struct(*order)).alias("first_ord"))
    known = _unmatched(distinct.withColumnRenamed("number", "ref_number"), register, [*doc, "ref_number"])
    return known.withColumnRenamed("ref_number", "number").filter("match_key <> ''").drop("_clean", "key")


def _unmatched(rows: DataFrame, register: DataFrame, spread: list[str]) -> DataFrame:
    """Rows whose spelling has no register row, with its match key, clean number and tracking key."""
    missing = resolve_numbers(rows, register).filter("matched_id is null").select(
        "ref_number", "match_key", clean_text("ref_number").alias("_clean"), tracking_key("ref_number").alias("key")
    )
    return lookup_join(rows, missing, ["ref_number"], spread, "inner")


def match_coverage(edges: DataFrame, register: DataFrame) -> DataFrame:
    """Matched, missing, total and percent per heading and overall (``heading`` NULL)."""
    counts = reference_counts(edges, register, ["heading"])
    per = counts.groupBy("heading").agg(
        F.sum(F.when(F.col("matched_id").isNotNull(), F.col("n")).otherwise(0)).alias("matched"),
        F.sum(F.when(F.col("matched_id").isNull(), F.col("n")).otherwise(0)).alias("missing"),
    )
    rolled = per.rollup("heading").agg(
        F.grouping("heading").cast("int").alias("is_total"),
        F.coalesce(F.sum("matched"), F.lit(0)).alias("matched"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
    )
    total = F.col("matched") + F.col("missing")
    return rolled.withColumn("total", total).withColumn("coverage_percent", percent("matched", "total", 100.0))


def document_match_summary(edges: DataFrame, register: DataFrame, doc: list[str]) -> DataFrame:
    """Distinct matched ids and missing items per document, official headings only."""
    official = edges.filter(F.col("heading").isin(list(L.OFFICIAL_COLUMN_BY_HEADING)))
    counts = reference_counts(official, register, [*doc, "heading"])
    return counts.groupBy(*doc).agg(
        F.count("matched_id").alias("matched_ids"),
        F.coalesce(F.sum(F.when(F.col("matched_id").isNull(), F.col("n"))), F.lit(0)).alias("missing_items"),
    ).withColumn("has_report", F.lit(True))


def missing_edges(edges: DataFrame, register: DataFrame, spread: list[str]) -> DataFrame:
    """Edges of the matcher's headings whose number has no register row, with tracking key."""
    official = edges.filter(F.col("heading").isin(list(L.OFFICIAL_COLUMN_BY_HEADING)))
    return _unmatched(official, register, spread).withColumnRenamed("_clean", "number").filter("key <> ''")


def missing_rollup(missing: DataFrame, order: list[str], source: str, text: str, examples: int = 5) -> DataFrame:
    """Per missing key: count, first spelling, headings in first-seen order, number of
    sources, first examples.

    Headings are a short fixed list and examples are cut to five per task before the
    shuffle, so no list grows with the data; the sources themselves are ``missing_sources``.
    """
    seen = F.struct(*order)
    # one pass serves headings and sources: both start from the same combined rows
    first = F.min(F.struct(seen.alias("o"), F.col("number").alias("number")))
    base = missing.groupBy("key", "heading", source).agg(F.count(F.lit(1)).alias("_n"), first.alias("_first"))
    headings = base.groupBy("key", "heading").agg(F.sum("_n").alias("_n"), F.min("_first").alias("_first"))
    entry = F.struct(F.col("_first.o").alias("o"), F.col("heading").alias("h"))
    per_key = headings.groupBy("key").agg(
        F.sum("_n").alias("count"),
        F.min("_first")["number"].alias("number"),
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["h"]).alias("headings"),
    )
    named = base.filter(clean_text(F.col(source).cast("string")) != "")
    sources = named.groupBy("key", source).agg(F.lit(1)).groupBy("key").agg(F.count(F.lit(1)).alias("source_count"))
    texts = missing.withColumn("_text", clean_text(text)).filter("_text <> ''").withColumn("_seen", seen)
    kept = first_n_by(texts.select("key", "_text", "_seen"), ["key"], ["_seen"], examples)
    listed = kept.groupBy("key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_seen", "_text"))), lambda e: e["_text"]).alias("examples")
    )
    joined = per_key.join(sources, "key", "left").join(listed, "key", "left")
    return joined.withColumn("source_count", F.coalesce("source_count", F.lit(0))).withColumn(
        "examples", F.coalesce("examples", F.array().cast("array<string>"))
    )


def missing_sources(missing: DataFrame, order: list[str], source: str) -> DataFrame:
    """Every (key, source) once, with its first-seen order and count."""
    rows = missing.filter(clean_text(F.col(source).cast("string")) != "")
    return rows.groupBy("key", source).agg(F.min(F.struct(*order)).alias("first_ord"), F.count(F.lit(1)).alias("count"))


def top_missing(rollup: DataFrame, n: int = 20) -> DataFrame:
    return rollup.orderBy(F.desc("count"), "number").limit(n)


def missing_delta(current: DataFrame, previous: DataFrame) -> DataFrame:
    """State of each key between two runs: new, resolved or persistent."""
    now = current.select("key", F.col("number").alias("_n1"), F.lit(True).alias("_now"))
    then = previous.select("key", F.col("number").alias("_n0"), F.lit(True).alias("_then"))
    state = F.when(F.col("_then").isNull(), "new").when(F.col("_now").isNull(), "resolved").otherwise("persistent")
    return now.join(then, "key", "full_outer").select("key", F.coalesce("_n1", "_n0").alias("number"), state.alias("state"))


def missing_deltas(missing: DataFrame, runs: DataFrame, run: str) -> DataFrame:
    """``missing_delta`` of every run against the run of the day before, in one pass.

    Each key is sent to its own run and to the next day's; runs that did not take place are left out.
    """
    sent = missing.select(
        "key",
        "number",
        F.inline(
            F.array(
                F.struct(F.col(run), F.lit(True).alias("_now"), F.lit(False).alias("_then")),
                F.struct(F.date_add(run, 1).alias(run), F.lit(False).alias("_now"), F.lit(True).alias("_then")),
            )
        ),
    )
    both = sent.groupBy(run, "key").agg(
        F.max(F.when(F.col("_now"), F.col("number"))).alias("_n1"), F.max("number").alias("_n0"), F.bool_or("_now").alias("_now"), F.bool_or("_then").alias("_then")
    )
    state = F.when(~F.col("_then"), "new").when(~F.col("_now"), "resolved").otherwise("persistent")
    placed = both.join(runs.select(run).distinct(), run, "left_semi")
    return placed.select(run, "key", F.coalesce("_n1", "_n0").alias("number"), state.alias("state"))


def delta_summary(delta: DataFrame, by: list[str] | None = None) -> DataFrame:
    counted = delta.groupBy(*(by or [])).agg(
        F.count_if(F.col("state") != "resolved").alias("current_missing"),
        F.count_if(F.col("state") != "new").alias("previous_missing"),
        F.count_if(F.col("state") == "new").alias("new_missing"),
        F.count_if(F.col("state") == "resolved").alias("resolved_missing"),
        F.count_if(F.col("state") == "persistent").alias("persistent_missing"),
    )
    return counted.withColumn("net_delta", F.col("current_missing") - F.col("previous_missing"))


# --- cells of a document ------------------------------------------------------------------
def _heading_lists(rows: DataFrame, doc: list[str]) -> DataFrame:
    """One row per (document, heading): its entries in order, and the place of the first.

    A document's entries come from its own page, one value already, so its lists are bounded by it.
    """
    entry = F.struct("ord", F.col("ref_number").alias("number"), "item")
    lists = rows.groupBy(*doc, "heading").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return lists.withColumn("_start", F.get("entries", F.lit(0))["ord"])


def relation_columns(edges: DataFrame, doc: list[str]) -> DataFrame:
    """One row per document: four official columns, basis text, hint list and note sections.

    Needs an ``ord`` that is the order of an edge in its document; gaps do not matter.
    """
    rows = edges.filter((F.col("heading") != "") & (F.col("item") != "") & ~is_noise("item"))
    lists = _heading_lists(rows, doc)
    lists = lists.withColumns(
        {
            "_numbers": F.array_join(F.transform(F.filter("entries", lambda e: e["number"] != ""), lambda e: e["number"]), "\n"),
            "_items": F.array_join(F.transform("entries", lambda e: e["item"]), "\n"),
            "_bullets": F.array_join(
                F.transform(
                    "entries",
                    lambda e: F.when(e["number"] != "", F.concat(F.lit("- "), e["number"], F.lit(": "), e["item"])).otherwise(
                        F.concat(F.lit("- "), e["item"])
                    ),
                ),
                "\n",
            ),
        }
    )
    head = F.concat(
        F.lit("["), F.col("heading"), F.lit("]\n" + L.NOTE_COMPARE_LINE + "\nSố lượng: "), F.size("entries").cast("string"), F.lit("\n")
    )
    column = {c: h for h, c in L.EXTRACTED_COLUMN_BY_HEADING.items()}
    cell = lambda h, v: F.coalesce(F.max(F.when(F.col("heading") == h, F.col(v))), F.lit(""))
    notes = F.array_sort(F.collect_list(F.struct("_start", "heading", F.concat(head, "_bullets").alias("s"))))
    return lists.groupBy(*doc).agg(
        *[cell(column[c], "_numbers").alias(c) for c in L.OFFICIAL_COLUMNS],
        cell("Văn bản căn cứ", "_items").alias("basis_text"),
        cell("Văn bản căn cứ", "_numbers").alias("basis_hint"),
        F.array_join(F.transform(notes, lambda e: e["s"]), "\n\n").alias("relation_note"),
        F.lit(True).alias("has_relations"),
    )


def relation_nested(edges: DataFrame, doc: list[str]) -> DataFrame:
    """One row per document: a map heading -> items, settled official headings only."""
    rows = typed_edges(edges).filter(F.col("heading").isin(list(L.OFFICIAL_COLUMN_BY_HEADING) + ["Văn bản hướng dẫn"]) & (F.col("item") != ""))
    items = F.transform("entries", lambda e: F.struct(e["number"].alias("number"), e["item"].alias("item")))
    pair = F.struct("heading", items.alias("items"))
    return _heading_lists(rows, doc).groupBy(*doc).agg(F.map_from_entries(F.collect_list(pair)).alias("relations"))


def match_columns(matched: DataFrame, doc: list[str], mode: str = "number", strategy: str = "multi_select") -> DataFrame:
    """Official column values of matched edges: numbers or ids, distinct, first-seen order.

    ``strategy``: ``multi_select`` joins with a comma, ``multi_line`` with a newline,
    ``first_only`` keeps the first.  One row per (document, official column).
    """
    names = F.create_map(*[F.lit(x) for pair in L.OFFICIAL_COLUMN_BY_HEADING.items() for x in pair])
    value = F.col("matched_id") if mode == "id" else F.col("matched_number")
    rows = matched.filter("is_matched").select(*doc, F.try_element_at(names, F.col("heading")).alias("official_column"), value.alias("value"), "ord")
    rows = rows.filter("official_column is not null")
    distinct = rows.groupBy(*doc, "official_column", "value").agg(F.min("ord").alias("ord"))
    if strategy == "first_only":
        return first_by(distinct, [*doc, "official_column"], ["ord"]).select(*doc, "official_column", "value")
    glue = "\n" if strategy == "multi_line" else ", "
    values = F.transform(F.array_sort(F.collect_list(F.struct("ord", "value"))), lambda e: e["value"])
    return distinct.groupBy(*doc, "official_column").agg(F.array_join(values, glue).alias("value"))


def note_items(edges: DataFrame, doc: list[str]) -> DataFrame:
    """``heading - number`` lines of headings that only feed the note, distinct, with order."""
    only = [h for h in L.TRACKED_HEADINGS if h not in L.OFFICIAL_COLUMN_BY_HEADING]
    rows = edges.filter(F.col("heading").isin(only) & (clean_text("ref_number") != ""))
    line = F.concat(F.col("heading"), F.lit(" - "), clean_text("ref_number"))
    return rows.groupBy(*doc, line.alias("note_line")).agg(F.min("ord").alias("ord"))


def apply_match(
    payloads: DataFrame, edges: DataFrame, register: DataFrame, doc: list[str], mode: str = "number", strategy: str = "multi_select"
) -> DataFrame:
    """Payloads with what the register match says: official columns, numbers not in the register,
    note lines after the old note, settled status.

    One match of the edges feeds all cells. Lists follow the order of the headings, then ``ord``.
    A document's references come from its page, so its cells are bounded by it.
    """
    matched = match_references(edges, register, [*doc, "ord"])
    place = F.array_position(F.array(*[F.lit(h) for h in L.TRACKED_HEADINGS]), F.col("heading"))
    first = F.min(F.struct(place.alias("place"), "ord")).alias("first")

    def listed(rows: DataFrame, value: Column, glue: str, out: str) -> DataFrame:
        distinct = rows.groupBy(*doc, value.alias("value")).agg(first)
        in_order = F.array_sort(F.collect_list(F.struct("first", "value")))
        return distinct.groupBy(*doc).agg(F.array_join(F.transform(in_order, lambda e: e["value"]), glue).alias(out))

    tracked = matched.filter(F.col("heading").isin(L.TRACKED_HEADINGS) & (clean_text("ref_number") != ""))
    missing = listed(tracked.filter(~F.col("is_matched") & (match_key("ref_number") != "")), clean_text("ref_number"), ", ", "_missing")
    only = tracked.filter(~F.col("heading").isin(list(L.OFFICIAL_COLUMN_BY_HEADING)))
    notes = listed(only, F.concat(F.col("heading"), F.lit(" - "), clean_text("ref_number")), "\n", "_notes")
    official = match_columns(matched, doc, mode, strategy).groupBy(*doc).agg(
        *[F.max(F.when(F.col("official_column") == c, F.col("value"))).alias(f"_m_{c}") for c in L.OFFICIAL_COLUMNS]
    )
    joined = payloads.join(official, doc, "left").join(missing, doc, "left").join(notes, doc, "left")
    note = F.array_join(F.filter(F.array(clean_text("relation_note"), F.coalesce("_notes", F.lit(""))), lambda x: x != ""), "\n")
    done = joined.withColumns(
        {
            **{c: F.coalesce(f"_m_{c}", F.lit("")) for c in L.OFFICIAL_COLUMNS},
            "not_in_register": F.coalesce("_missing", F.lit("")),
            "relation_note": note,
            "relation_status": relation_status("relation_status"),
        }
    )
    return done.drop("_missing", "_notes", *[f"_m_{c}" for c in L.OFFICIAL_COLUMNS])


# --- reverse links ------------------------------------------------------------------------
def reverse_links(edges: DataFrame, order: list[str]) -> DataFrame:
    """For each "A cites B": (B, column, A) once, with its first-seen order.

    Citations go to B's "guided by", "amended by" links to B's "amends".  The result
    stays in rows: the list of a law that a third of all documents cite is not one cell.
    """
    targets = F.create_map(F.lit("Văn bản căn cứ"), F.lit("guided_by"), F.lit("Văn bản sửa đổi, bổ sung"), F.lit("amends"))
    rows = edges.withColumn("target_column", F.try_element_at(targets, F.col("heading"))).filter(
        (F.col("target_column").isNotNull()) & (clean_text("ref_number") != "") & (clean_text("src_number") != "")
    )
    return rows.groupBy(
        clean_text("ref_number").alias("target_number"), "target_column", clean_text("src_number").alias("value")
    ).agg(F.min(F.struct(*order)).alias("first_ord"))


def apply_reverse_links(register: DataFrame, links: DataFrame, row: str = "_row_number") -> DataFrame:
    """Links new to their register row: (row, column, value, first_ord); existing values stay out.

    ``links`` targets are resolved once per distinct number, so a much-cited number is one
    lookup.  Values already in the row's list are removed by an anti join in rows.
    """
    from vellum.operators.register import resolve_rows

    numbers = links.select(F.col("target_number").alias("number")).distinct()
    resolved = resolve_rows(numbers, register).select(F.col("number").alias("target_number"), F.col("target_row").alias(row))
    placed = lookup_join(links, resolved.filter(F.col(row).isNotNull()), ["target_number"], ["value"], "inner")
    existing = None
    for column in ["guided_by", "amends"]:
        rows = register.select(row, F.lit(column).alias("target_column"), F.explode(unique_list(column)).alias("value"))
        existing = rows if existing is None else existing.unionByName(rows)
    fresh = placed.join(existing, [row, "target_column", "value"], "left_anti")
    return fresh.groupBy(row, "target_column", "value").agg(F.min("first_ord").alias("first_ord"))


def write_reverse_links(register: DataFrame, links: DataFrame, row: str = "_row_number", glue: str = ", ") -> DataFrame:
    """The register with new links behind the old ones in ``guided_by`` and ``amends``.

    Cells without a new link stay as they are. A cell is one value of the register, so its links meet
    in its row; ``apply_reverse_links`` gives them as rows where that is not wanted.
    """
    columns = ["guided_by", "amends"]
    fresh = apply_reverse_links(register.withColumns({c: split_values(c) for c in columns}), links, row)
    in_order = lambda c: F.array_sort(F.collect_list(F.when(F.col("target_column") == c, F.struct("first_ord", "value"))))
    new = fresh.groupBy(row).agg(*[F.transform(in_order(c), lambda e: e["value"]).alias(f"_new_{c}") for c in columns])
    joined = register.join(new, row, "left")
    cells = {
        c: F.when(F.size(f"_new_{c}") > 0, F.array_join(F.concat(split_values(c), F.col(f"_new_{c}")), glue)).otherwise(F.col(c)) for c in columns
    }
    return joined.withColumns(cells).drop(*[f"_new_{c}" for c in columns])


def allowed_values(values: Column, allowed: Column) -> Column:
    """Struct of the values written and the values skipped by a column's allowed list."""
    named = unique_list(F.transform(values, clean_text))
    return F.struct(
        F.filter(named, lambda v: F.array_contains(allowed, v)).alias("written"),
        F.filter(named, lambda v: ~F.array_contains(allowed, v)).alias("skipped"),
    )
