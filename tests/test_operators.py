"""Operators on small hand-built frames: ties, blanks, duplicates, heavy keys, properties."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.operators import dedup, documents, expiry, listing, register, relations, reports, sequences, skew, tasks, validation
from vellum.sources.config import RuleSet

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# --- heavy keys, ranks, parts -------------------------------------------------------------
def test_lookup_join_splits_heavy_keys_and_keeps_every_row(spark):
    facts = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("800", 2)], "k string, v int")
    for pieces in (10, 10**6):
        joined = skew.lookup_join(facts, dim, ["k"], ["id"], rows_per_piece=pieces)
        got = {(r["k"] if r["v"] else "none"): r["n"] for r in joined.groupBy("k", "v").agg(F.count("*").alias("n")).collect() if r["v"]}
        assert joined.count() == 1000 and got == {"hot": 700, "800": 1}
    assert skew.lookup_anti(facts, dim, ["k"], ["id"]).count() == 299


def test_heavy_key_really_has_pieces(spark):
    facts = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    (heavy,) = skew.heavy_keys(facts, ["k"], 10).collect()
    assert heavy["_pieces"] == 100 and heavy["_hot"] == spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]


@pytest.mark.parametrize("chunk", [1, 3, 100_000])
@pytest.mark.parametrize("partitions", ["1", "8"])
def test_running_values_match_a_plain_loop(spark, chunk, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rng = random.Random(7)
        data = [(rng.choice(["a", "b", None]), o, rng.randint(0, 5)) for o in rng.sample(range(200), 60)]
        df = spark.createDataFrame(data, "g string, ord long, v int")
        want, total = [], {}
        for g, o, v in sorted(data, key=lambda r: r[1]):
            total[g] = total.get(g, 0) + v
            want.append((o, total[g]))
        assert rows(skew.running_sum(df, ["g"], "ord", F.col("v"), "s", chunk), "ord", "s") == sorted(want)
        whole = rows(skew.position(df, [], "ord", "p", chunk), "ord", "p")
        assert [p for _, p in whole] == list(range(1, 61))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_cell_per_document_whatever_the_order_numbers(spark):
    schema = "doc string, ord long, heading string, ref_number string, item string"
    heads = ["Văn bản căn cứ", "Văn bản thay thế", "Văn bản căn cứ"]
    data = [("d", n, h, f"{k}/2020/TT-A", f"item {k}") for k, (n, h) in enumerate(zip([1, 10001, 10002], heads))]
    edges = spark.createDataFrame(data, schema)
    (row,) = relations.relation_columns(edges, ["doc"]).collect()
    assert row["basis"] == "0/2020/TT-A\n2/2020/TT-A"
    first, second = row["relation_note"].split("\n\n")
    assert first.startswith("[Văn bản căn cứ]") and "Số lượng: 2" in first and second.startswith("[Văn bản thay thế]") and "Số lượng: 1" in second
    (nested,) = relations.relation_nested(edges, ["doc"]).collect()
    assert [e["item"] for e in nested["relations"]["Văn bản căn cứ"]] == ["item 0", "item 2"]
    matched = edges.withColumns({"is_matched": F.lit(True), "matched_number": F.col("ref_number"), "matched_id": F.col("item")})
    assert {r["value"] for r in relations.match_columns(matched, ["doc"]).collect()} == {"0/2020/TT-A, 2/2020/TT-A"}


def test_positions_of_sparse_and_negative_order_numbers(spark):
    numbers = [-(2**62), -7, 0, 3, 99_999, 100_000, 10**10, 10**15 + 1, 2**62]
    df = spark.createDataFrame([(n, "g" if n % 2 else None) for n in numbers], "ord long, g string")
    assert [p for _, p in rows(skew.position(df, [], "ord", "p"), "ord", "p")] == list(range(1, 10))
    odd, even = [n for n in numbers if n % 2], [n for n in numbers if not n % 2]
    got = {r["ord"]: r["p"] for r in skew.position(df, ["g"], "ord", "p").collect()}
    assert got == {n: i + 1 for part in (odd, even) for i, n in enumerate(part)}


# --- dedup --------------------------------------------------------------------------------
def test_dedup(spark):
    df = spark.createDataFrame([("k", "aa", 2), ("k", "bb", 1), ("k", "c", 0), ("j", None, 5)], "k string, t string, ord int")
    assert rows(dedup.dedup_first(df, ["k"], ["ord"]), "k", "t") == [("j", None), ("k", "c")]
    assert rows(dedup.dedup_longest(df, ["k"], "t", ["ord"]), "k", "ord") == [("j", 5), ("k", 1)]
    assert rows(dedup.merge_sources([df, df.withColumn("t", F.lit("zz"))], ["k"], "t", ["ord"]), "k", "t") == [("j", "zz"), ("k", "bb")]


def test_register_index_lowest_complete_row_wins(spark):
    df = spark.createDataFrame([(5, "B", "01/2020/TT-BGDĐT"), (3, "", "01/2020/TT-BGDDT"), (4, "A", "01 / 2020 / tt–bgddt"), (6, "C", " "), (7, "D", "---")], "_row_number long, id string, number string")
    assert rows(dedup.register_index(df), "match_key", "matched_id", "matched_row") == [("01/2020/TTBGDDT", "A", 4)]


def test_primary_link(spark):
    df = spark.createDataFrame([(1, "Hiệu lực", 1), (1, "Thông tư 1/2020/TT-A1", 2), (1, "Thông tư 2/2020/TT-A1", 3), (2, "In", 1), (2, "abc", 2)], "p int, text string, ord int")
    assert rows(dedup.primary_link(df, ["p"]), "p", "ord") == [(1, 2), (2, 2)]


# --- sequences ----------------------------------------------------------------------------
def test_convergence(spark):
    reads = [("a", k, "x") for k in range(1, 6)] + [("b", k, str(k)) for k in range(1, 10)] + [("c", 1, "x"), ("c", 2, "x")]
    df = spark.createDataFrame(reads, "page string, attempt int, item string")
    assert rows(sequences.snapshot_convergence(df, ["page"], "item"), "page", "stop_attempt", "merged_count") == [("a", 4, 1), ("b", None, 8), ("c", None, 1)]
    expected = df.withColumn("expected", F.lit(3))
    assert rows(sequences.snapshot_convergence(expected, ["page"], "item", "expected"), "page", "stop_attempt") == [("a", 4), ("b", 3), ("c", None)]


def test_empty_streak(spark):
    df = spark.createDataFrame([("f", i, n) for i, n in enumerate([3, 0, 2, 0, 0, 0], 1)] + [("g", 1, 0), ("g", 2, 1)], "f string, page_index int, document_count int")
    assert rows(sequences.empty_streak_stop(df, ["f"]), "f", "stop_page") == [("f", 5), ("g", None)]
    assert sequences.pages_before_stop(df, ["f"]).count() == 7


def test_numbered_rows_and_slices(spark):
    lines = ["x", "1", "Thông tư", "A Hiệu lực Tổng quan", "rest", "2 Luật B", "more", "3", "Tổng quan", "12345 no"]
    df = spark.createDataFrame([(1, lines)], "p int, lines array<string>")
    assert rows(sequences.numbered_rows(df, "lines", ["p"]), "number", "title") == [(1, "Thông tư A Hiệu lực"), (2, "Luật B more")]
    cut = spark.createDataFrame([(1, ["a", "Có tất cả 3 văn bản", "b", "HỎI ĐÁP PHÁP LUẬT", "c"]), (2, ["a", "b"])], "p int, lines array<string>")
    assert rows(sequences.slice_between_markers(cut, "lines", "o"), "p", "o") == [(1, ["b"]), (2, ["a", "b"])]


def test_sequence_ids(spark):
    df = spark.createDataFrame([(30,), (10,), (20,)], "ord long")
    assert rows(sequences.assign_sequence(df, "ord"), "ord", "sequence_id") == [(10, "VB174"), (20, "VB175"), (30, "VB176")]


# --- listing ------------------------------------------------------------------------------
RULES = RuleSet(accepted_doc_types=["Thông tư"], required_paths=["/a/"], excluded_paths=["/b/"], skip_doc_types=["Luật"], title_keywords=["cấm"], url_keywords=["xx"], number_keywords=["/qđ-"])


def _listing(spark, data):
    return spark.createDataFrame(data, "ord long, url string, title string, doc_type string, doc_number string")


def test_listing_reasons_and_statistics(spark):
    data = [
        (1, "http://h/a/1", "cấm", "Thông tư", "1"), (2, "http://h/a/1", "tốt", "Thông tư", "1"), (3, "http://h/a/1", "tốt", "Thông tư", "1"),
        (4, "http://h/a/b/1", "t", "Thông tư", "1"), (5, "http://h/a/2", "Luật 1", "", "1"), (6, "http://h/a/xx", "t", "Thông tư", "1"),
        (7, "http://h/a/3", "t", "Thông tư", "1/QĐ-X"), (8, "", "t", "Thông tư", ""), (9, "http://h/a/9", "Thông tư 5", "", "5"),
    ]
    df = _listing(spark, data)
    out = listing.listing_outcomes(df, RULES, [], ["ord"])
    assert [o for _, o in rows(out, "ord", "outcome")] == [
        "exclude_title_keywords", "", "duplicate_url", "required_url_path_contains", "doc_type", "exclude_url_keywords", "exclude_so_hieu_keywords", "duplicate_url", "",
    ]
    stats = listing.filter_stats(out, []).first().asDict()
    assert stats["input_links"] == 9 == stats["kept_links"] + stats["duplicate_url"] + sum(stats[r] for r in L.REJECT_REASONS) + stats["other"]
    typed = df.withColumn("crawl", F.lit("10"))
    reason = listing.listing_reject_reason(RULES, crawl_type_id="crawl")
    assert typed.filter("ord = 2").select(reason).first()[0] == "doc_type"


def test_listing_issue_lists(spark):
    df = _listing(spark, [(1, "", "", "", ""), (2, "http://h/b/xx", "Cấm", "Luật", "1/QĐ-X")])
    got = df.select("ord", listing.listing_errors(RULES).alias("e"), listing.listing_warnings().alias("w")).orderBy("ord").collect()
    assert got[0]["e"] == ["missing_url"] and got[0]["w"] == []
    assert [e.split(":")[0] for e in got[1]["e"]] == [
        "excluded_path", "not_in_required_paths", "blocked_url_keyword", "title_keyword", "number_keyword", "skipped_doc_type", "not_accepted_doc_type",
    ]


def test_pair_by_rank(spark):
    texts = spark.createDataFrame([(1, 1, 7, "A"), (1, 2, 8, ""), (1, 3, 9, "C")], "page int, ord long, number int, title string")
    links = spark.createDataFrame([(1, 10, "u1", "x"), (1, 20, "u2", "y"), (1, 30, "u1", "z"), (1, 40, "u3", "w")], "page int, ord long, url string, title string")
    got = rows(listing.pair_by_rank(texts, links, ["page"]), "link_ord", "url", "title", "row_number")
    assert got == [(10, "u1", "A", 7), (20, "u2", "y", None), (40, "u3", "w", None)]


# --- documents ----------------------------------------------------------------------------
def test_document_fields_next_line_and_missing(spark):
    lines = ["Số hiệu", "1/2020/TT-A1", "Thông tư 1/2020/TT-A1 về việc học", "Ban hành: 05/06/2020", "Áp dụng: 1/7/2020"]
    df = spark.createDataFrame([(lines,), ([],)], "lines array<string>")
    a, b = [r["info"] for r in documents.document_fields(df, "lines").collect()]
    assert (a["number"], a["doc_type"], a["issued"], a["effective_date"], a["field"]) == ("1/2020/TT-A1", "Thông tư", "05/06/2020", "1/7/2020", "")
    assert a["title"] == "Thông tư 1/2020/TT-A1 về việc học" and b["number"] == "" and b["title"] == ""


def test_payload_gates(spark):
    df = spark.createDataFrame(
        [("1", "Thông tư", "VBHN 1", "1", "u"), ("2", "", "t", "", "u"), ("3", "Công văn", "t", "1", "u"), ("4", "Nghị quyết", "t", "1", "u"), ("5", "Luật", "t", "1", "http://cong-van")],
        "id string, doc_type string, title string, number string, url string",
    )
    gated = df.withColumn("gate_code", documents.write_gate_code()).withColumn("m", documents.write_gate_message())
    assert [c for _, c in rows(gated, "id", "gate_code")] == ["EXCLUDED_KEYWORD", "MISSING_SO_HIEU", "SKIP_DOC_TYPE", "DOC_TYPE_NOT_ACCEPTED", "EXCLUDED_KEYWORD"]
    assert gated.filter("id = '5'").first()["m"].endswith(": cong-van")
    assert rows(df.withColumn("r", documents.payload_skip_reason(RuleSet())), "id", "r")[4] == ("5", "exclude_url_keywords:cong-van")


def test_map_field(spark):
    mapping = spark.createDataFrame([("Giáo  dục", "GD"), ("giáo dục", "XX")], "name string, value string")
    df = spark.createDataFrame([(1, "GIÁO DỤC "), (2, "khác"), (3, None)], "i int, f string")
    assert rows(documents.map_field(df, mapping, "f", "v"), "i", "v") == [(1, "GD"), (2, ""), (3, "")]


# --- relations ----------------------------------------------------------------------------
def test_nearest_heading_against_brute_force(spark):
    rng = random.Random(3)
    heads = [(p, o, h, float(rng.randint(0, 9) * 10), float(rng.randint(0, 600))) for p in (1, 2) for o, h in enumerate(rng.sample(L.DIAGRAM_HEADINGS, 5))]
    items = [(rng.choice((1, 2, 3)), 100 + i, f"Thông tư {i}/2020/TT-BTC", float(rng.randint(0, 120)), float(rng.randint(0, 600))) for i in range(80)]
    want = []
    for p, o, _, top, left in items:
        reach = [(t, le, ho, h) for hp, ho, h, t, le in heads if hp == p and t <= top and abs(le - left) <= 240]
        if reach:
            want.append((p, o, max(reach)[3]))
    df = spark.createDataFrame(heads + items, "page int, ord long, text string, top double, left double")
    got = relations.nearest_heading(relations.item_candidates(df, ["page"]), relations.heading_candidates(df, ["page"]), ["page"], ["ord"])
    assert rows(got, "page", "ord", "heading") == sorted(want)


REGISTER = [(2, "ID1", "01/2020/TT-BGDĐT"), (3, "ID2", "2/2020/NĐ-CP"), (4, "", "3/2020/QH15"), (5, "ID5", "2/2020/ND-CP")]


def _register(spark):
    return spark.createDataFrame(REGISTER, "_row_number long, id string, number string")


EDGES = [
    ("a", 1, "Văn bản căn cứ", "01/2020/tt-bgddt"), ("a", 2, "Văn bản căn cứ", "9/2020/TT-X1"), ("a", 3, "Văn bản sửa đổi, bổ sung", "2/2020/NĐ-CP"),
    ("b", 1, "Văn bản căn cứ", "9/2020/TT–X1"), ("b", 2, "Văn bản thay thế", "3/2020/QH15"), ("b", 3, "Văn bản liên quan", "8/2020/TT-X1"), ("b", 4, "Văn bản căn cứ", ""),
]


def _edges(spark):
    df = spark.createDataFrame(EDGES, "doc string, ord long, heading string, ref_number string")
    return df.withColumns({"src_number": F.concat(F.col("doc"), F.lit("/2021/TT")), "item": F.concat("heading", F.lit(" "), "ref_number")})


def test_match_and_coverage(spark):
    matched = relations.match_references(_edges(spark), _register(spark), ["doc", "ord"])
    assert [(d, o, m) for d, o, m in rows(matched, "doc", "ord", "matched_id") if m] == [("a", 1, "ID1"), ("a", 3, "ID2")]
    total = relations.match_coverage(_edges(spark), _register(spark)).filter("is_total = 1").first()
    assert (total["matched"], total["missing"], total["coverage_percent"]) == (2, 4, 33.33)
    empty = relations.match_coverage(_edges(spark).filter("false"), _register(spark)).filter("is_total = 1").first()
    assert empty is None or empty["coverage_percent"] == 100.0


def test_missing(spark):
    missing = relations.missing_references(_edges(spark), _register(spark), ["doc"], ["ord"])
    assert rows(missing, "doc", "number") == [("a", "9/2020/TT-X1"), ("b", "3/2020/QH15"), ("b", "9/2020/TT–X1")]
    gone = relations.missing_edges(_edges(spark), _register(spark), ["doc", "ord"])
    roll = relations.missing_rollup(gone, ["doc", "ord"], "doc", "item").collect()
    assert [(r["key"], r["number"], r["count"], r["source_count"], len(r["examples"])) for r in roll] == [("9/2020/TT-X1", "9/2020/TT-X1", 2, 2, 2)]


def test_delta_properties(spark):
    now = spark.createDataFrame([("a", "A"), ("b", "B")], "key string, number string")
    old = spark.createDataFrame([("b", "B"), ("c", "C"), ("d", "D")], "key string, number string")
    s = relations.delta_summary(relations.missing_delta(now, old)).first()
    assert s["new_missing"] + s["persistent_missing"] == s["current_missing"] == 2
    assert s["resolved_missing"] + s["persistent_missing"] == s["previous_missing"] == 3 and s["net_delta"] == -1


def test_reverse_links_are_idempotent(spark):
    reg = spark.createDataFrame([(2, "ID1", "01/2020/TT-BGDĐT", ["a/2021/TT", "old"], []), (3, "ID2", "2/2020/NĐ-CP", [], [])],
                                "_row_number long, id string, number string, guided_by array<string>, amends array<string>")
    links = relations.reverse_links(_edges(spark), ["doc", "ord"])
    fresh = relations.apply_reverse_links(reg, links)
    assert rows(fresh, "_row_number", "target_column", "value") == [(3, "amends", "a/2021/TT")]
    again = spark.createDataFrame([(2, "ID1", "01/2020/TT-BGDĐT", ["a/2021/TT"], []), (3, "ID2", "2/2020/NĐ-CP", [], ["a/2021/TT"])], reg.schema)
    assert relations.apply_reverse_links(again, links).count() == 0


def test_match_columns_options(spark):
    edges = _edges(spark).unionByName(_edges(spark).filter("ord = 1").withColumn("ord", F.lit(9).cast("long")))
    matched = relations.match_references(edges, _register(spark), ["doc", "ord"])
    assert rows(relations.match_columns(matched, ["doc"]), "official_column", "value") == [("amended_by", "2/2020/NĐ-CP"), ("basis", "01/2020/TT-BGDĐT")]
    assert rows(relations.match_columns(matched, ["doc"], "id", "first_only"), "official_column", "value") == [("amended_by", "ID2"), ("basis", "ID1")]


# --- register -----------------------------------------------------------------------------
def test_lookup_prefers_exact_then_lowest(spark):
    targets = spark.createDataFrame([("2/2020/ND-CP",), ("2/2020/nđ cp",), ("x",), ("",)], "number string")
    assert rows(register.resolve_rows(targets, _register(spark)), "number", "target_row", "matched_by") == [
        ("", None, "none"), ("2/2020/ND-CP", 5, "exact"), ("2/2020/nđ cp", 3, "normalised"), ("x", None, "none"),
    ]


UPSERT = "_row_number long, number string, title string, field string"


def test_upsert_rules_and_idempotence(spark):
    old = spark.createDataFrame([(2, "1/2020/A1", "t1", "F"), (3, "2/2020/A1", "t2", ""), (4, "3/2020/A1", "t3", "")], UPSERT)
    new = spark.createDataFrame(
        [(1, "1/2020/a1", "n1", "G"), (2, "2/2020/A1", "n2", ""), (3, "2/2020/A1", "", "H"), (4, "2/2020/A1", "n4", "I"), (5, "9/2020/A1", "z", ""), (6, "9/2020/a 1", "y", "K"), (7, " ", "q", "q")],
        "ord long, number string, title string, field string",
    )
    cols = ["number", "title", "field"]
    once = register.upsert_protected(old, new, cols, protected=["field"])
    assert rows(once, "_row_number", *cols, "action") == [
        (2, "1/2020/a1", "n1", "F", "updated"), (3, "2/2020/A1", "n4", "H", "updated"), (4, "3/2020/A1", "t3", "", "kept"), (5, "9/2020/a 1", "y", "K", "inserted"),
    ]
    twice = register.upsert_protected(once.drop("action"), new, cols, protected=["field"])
    assert rows(twice, "_row_number", *cols) == rows(once, "_row_number", *cols)
    blank = register.upsert_protected(old, new, cols, protected=["field"], only_blank=True)
    assert rows(blank.filter("_row_number < 5"), "_row_number", "title") == [(2, "t1"), (3, "t2"), (4, "t3")]


def test_upsert_into_empty_register(spark):
    old = spark.createDataFrame([], UPSERT)
    new = spark.createDataFrame([(5, "b", "t", ""), (4, "a", "t", "")], "ord long, number string, title string, field string")
    assert rows(register.upsert_protected(old, new, ["number", "title", "field"]), "_row_number", "number") == [(2, "a"), (3, "b")]


def test_transfer(spark):
    cols = [*L.TRANSFER_REQUIRED, "approval_status", "process_status", "status_date"]
    full = {c: "x" for c in cols}
    data = [(2, {**full, "number": "5/2020/A1"}), (3, {**full, "number": "5/2020/a 1"}), (4, {**full, "number": "01/2020/TT-BGDDT"}), (5, {**full, "number": "6/2020/A1", "impact": " "})]
    staging = spark.createDataFrame([(n, *[d[c] for c in cols]) for n, d in data], "_row_number long, " + ", ".join(f"{c} string" for c in cols))
    marked, moved = register.transfer(staging, _register(spark), F.lit("now"))
    assert rows(marked, "_row_number", "outcome", "process_status", "status_date") == [
        (2, "ok", L.TRANSFERRED, "now"), (3, "duplicate", L.DUPLICATE_NUMBER, "x"), (4, "duplicate", L.DUPLICATE_NUMBER, "x"), (5, "missing_fields", L.MANUAL_CHECK, "x"),
    ]
    assert rows(moved, "_row_number", "status_date") == [(6, "now")]


def test_retention_days(spark):
    now = F.lit("2024-04-10 08:00:00").cast("timestamp_ntz")
    ages = {89: "12/01/2024 08:00:00", 90: "11/01/2024 08:00:00", 91: "10/01/2024"}
    data = [(n, L.IRRELEVANT, t) for n, t in ages.items()] + [(1, L.IRRELEVANT, ""), (2, L.WAITING_CHECK, "10/01/2020")]
    df = spark.createDataFrame(data, "_row_number long, approval_status string, status_date string")
    assert [r[0] for r in rows(register.purge_irrelevant(df, now), "_row_number")] == [1, 2, 89]


def test_updates_and_stamp(spark):
    df = spark.createDataFrame([(2, "a", "p"), (3, "b", "q")], "_row_number long, title string, process_status string")
    ups = spark.createDataFrame([(2, "title", "x", 1), (2, "title", None, 2), (2, "zzz", "y", 3), (3, "process_status", L.IRRELEVANT, 1), (9, "title", "n", 1)], "row_number long, column string, value string, ord int")
    assert sorted(map(tuple, register.apply_updates(df, ups, ["title", "process_status"]).collect()), key=str) == [(2, None, "p"), (3, "b", "q")]
    st = spark.createDataFrame([(1, L.IRRELEVANT, ""), (2, L.IRRELEVANT, "old"), (3, "x", "old"), (4, "x", "old")], "i int, approval_status string, status_date string")
    got = register.stamp_status_date(st, F.col("i") < 4, F.lit("now"))
    assert [d for _, d in rows(got, "i", "status_date")] == ["now", "old", "", "old"]


def test_expired_cascade(spark):
    df = spark.createDataFrame([(2, "A/1", "B/1, c/1"), (3, "b/1", "x"), (4, "D/1", "x;y"), (5, "E/1", "B/1\nb/1\nz")], "_row_number long, number string, basis string")
    gone = spark.createDataFrame([("B/1",), (" ",)], "number string")
    assert rows(register.expired_cascade(df, gone), "_row_number", "basis") == [(2, "c/1"), (4, "x;y"), (5, "z")]


# --- expiry -------------------------------------------------------------------------------
def test_scan_rules(spark):
    clause = "Điều khoản thi hành: {} Điều 9 Thông tư 7/2000/TT-A1 hết hiệu lực."
    docs = [
        ("9/2024/TT-A1", clause.format("Thông tư 1/2020/TT-A1 hết hiệu lực một phần từ 01/01/2020.")),
        ("9/2024/TT-A2", clause.format("Thông tư 1/2020/TT-A1 hết hiệu lực.")),
        ("9/2024/TT-A3", clause.format("Thông tư 1/2020/TT-A1 và 2/2020/TT-A1 bị bãi bỏ từ 1/2/2020, 3/2/2020.")),
        ("9/2024/TT-A4", clause.format("Thông tư 1/2020/TT-A1 hết hiệu lực từ 01/01/2999.")),
        ("9/2024/TT-A5", clause.format("Thông tư 9/2024/tt-a5 hết hiệu lực.")),
        ("9/2024/TT-A6", "Thông tư 1/2020/TT-A1 hết hiệu lực."),
    ]
    df = spark.createDataFrame([(n, "t", "http://x", h, "") for n, h in docs] + [("9/2024/TT-A7", "t", "http://x", "", "500"), ("n", "t", "x", "", "")], "number string, title string, url string, html string, fetch_error string")
    got = rows(expiry.scan_expired(df, F.lit(D(2024, 1, 1))), "new_number", "old_number", "applied_date", "status")
    assert got == [
        ("9/2024/TT-A1", "1/2020/TT-A1", "01/01/2020", L.EXPIRY_MANUAL), ("9/2024/TT-A2", "1/2020/TT-A1", "", L.EXPIRY_NO_DATE),
        ("9/2024/TT-A3", "1/2020/TT-A1", "3/2/2020", L.EXPIRY_WAITING), ("9/2024/TT-A3", "2/2020/TT-A1", "3/2/2020", L.EXPIRY_WAITING),
        ("9/2024/TT-A4", "1/2020/TT-A1", "01/01/2999", L.EXPIRY_FUTURE), ("9/2024/TT-A7", "", "", L.EXPIRY_FETCH_FAILED),
    ]
    log = expiry.expiry_log_rows(expiry.scan_expired(df, F.lit(D(2024, 1, 1))), F.lit("now"))
    assert len(log.columns) == 14


# --- tasks and reports --------------------------------------------------------------------
def _tasks(spark, data):
    return spark.createDataFrame(data, "_row_number long, number string, title string, task_id string, task_url string, sync_status string, last_sync string, current_pic string, current_checkpoint string, next_due string")


def test_enrich_and_groups(spark):
    base = lambda n, status, pic, step, due: (n, f"{n}/2026", "t", f"T{n}", "u", status, "", pic, step, due)
    df = _tasks(spark, [
        base(1, "", "PC | a@x", "b", "09/05/2026"), base(2, "", "a@x", "PC | c@x | Hạn hoàn thành: 03/05/2026 | s", "x"), base(3, L.TASK_DONE, "", "", "01/01/2020"),
        base(4, L.TASK_DELETED, "", "", "01/01/2020"), base(5, "", "", "", "10/05/2026"), base(6, "", "", "", "11/05/2026"),
    ])
    out = reports.report_rows(df, F.lit(D(2026, 5, 10)))
    assert rows(out, "_row_number", "department", "pic", "days_overdue") == [(1, "PC", "a@x", 1), (2, "PC", "c@x", 7), (3, "", "", 0), (5, "", "", 0), (6, "", "", 0)]
    assert [tuple(r) for r in reports.group_overdue(out, "department").collect()] == [("PC", 2, 2, 100.0), ("", 3, 0, 0.0)]
    alerts = reports.overdue_alerts(df, F.lit(D(2026, 5, 10)))
    assert rows(alerts, "_row_number", "department", "pic") == [(1, "", "PC | a@x"), (2, "PC", "c@x")]
    state = spark.createDataFrame([(D(2026, 5, 10), "T1"), (D(2026, 5, 9), "T2")], "sent_date date, task_id string")
    assert rows(reports.not_sent_today(alerts, state, F.lit(D(2026, 5, 10))), "task_id") == [("T2",)]
    assert reports.not_sent_today(alerts, state, F.lit(D(2026, 5, 10)), force=True).count() == 2


def test_state_keeps_newest_dates(spark):
    state = spark.createDataFrame([(D(2026, 4, d), "T", "p", d) for d in range(1, 31)], "sent_date date, task_id string, pic string, days int")
    done = spark.createDataFrame([(1, "T", "q", 9)], "_row_number long, task_id string, pic string, days_overdue int")
    once = reports.merge_state(state, done, F.lit(D(2026, 5, 1)))
    twice = reports.merge_state(once, done, F.lit(D(2026, 5, 1)))
    assert once.count() == twice.count() == 30 and once.agg(F.min("sent_date")).first()[0] == D(2026, 4, 2)


def test_active_items(spark):
    item = lambda t, ord_, hint, checked, title: (t, ord_, hint, checked, title)
    full = "PC | a@x | Hạn hoàn thành: 03/05/2026 | s{}"
    df = spark.createDataFrame([
        item("a", 1, "1", True, full.format(1)), item("a", 2, "2", False, full.format(2)), item("a", 3, "3", False, full.format(3)),
        item("b", 1, "1", True, full.format(1)), item("b", 2, "2", True, full.format(2)), item("c", 1, "1", False, "x | y | z"),
    ], "task_id string, ord int, order_hint string, is_checked boolean, title string")
    assert rows(tasks.active_items(df, ["task_id"]), "task_id", "item.step", "all_checked") == [("a", "s2", False), ("b", "s2", True)]


def test_skip_categories_cover_all(spark):
    cols = "_row_number long, number string, title string, task_id string, sync_status string, status_date string, scanned_at string, last_sync string, process_status string, approval_status string"
    row = lambda n, **kw: tuple({**dict(_row_number=n, number="1", title="t", task_id="", sync_status="", status_date="01/06/2026", scanned_at="", last_sync="", process_status="", approval_status=""), **kw}.values())
    df = spark.createDataFrame([
        row(0), row(1, title=" "), row(2, task_id="x"), row(3, task_id="x", sync_status=L.TASK_DELETED), row(4, sync_status=L.TASK_CREATED), row(5, status_date=""),
        row(6, status_date="?"), row(7, status_date="01/01/2020"), row(8), row(9, process_status="Đã chuyển"),
    ], cols)
    out = df.withColumn("reason", tasks.candidate_reason(F.lit(D(2026, 1, 1)), require_eligible=True)).withColumn("c", F.when(F.col("reason") != "", tasks.skip_category()))
    assert [c for _, c in rows(out.fillna("ok", ["c"]), "_row_number", "c")] == [
        "missing_required_field", "missing_required_field", "has_planner_task_id", "deleted_planner_task", "unknown", "missing_create_date",
        "invalid_create_date", "before_create_from_date", "status_not_eligible", "ok",
    ]


# --- validation ---------------------------------------------------------------------------
def test_verdict(spark):
    names = ["config_errors", "documents", "invalid_documents", "invalid_payloads", "result_errors", "sent_not_ok", "sent_skipped", "sent_without_report", "relation_missing_documents", "warned_documents", "result_warnings"]
    df = spark.createDataFrame([(0, 5, 0, 0, 0, 0, 0, 0, 1, 0, 0), (1, 0, 0, 0, 2, 0, 0, 0, 0, 0, 0)], names)
    a, b = validation.run_verdict(df).collect()
    assert a["ok"] and a["warnings"] == ["relation_missing_documents:1"]
    assert not b["ok"] and b["errors"] == ["config_errors:1", "no_documents", "result_errors:2"]


def test_capped_sections(spark):
    df = spark.range(100).select(F.when(F.col("id") % 2 == 0, "invalid").otherwise("free").alias("s"), "id")
    got = validation.capped_sections(df, "s", ["id"], {"invalid": 3})
    assert {r["s"]: r["n"] for r in got.groupBy("s").agg(F.count("*").alias("n")).collect()} == {"invalid": 3, "free": 50}


def test_only_the_value_true_is_success(spark):
    answers = ['{"ok":"true"}', '{"ok":1}', '{"ok":null}', "{}"]
    df = spark.createDataFrame([("sent", a) for a in answers], "status string, result string")
    assert {r["outcome"] for r in validation.result_outcome(df).collect()} == {"not_ok"}


def test_expiry_numbers_with_many_digits_or_hyphens(spark):
    text = "Điều khoản thi hành: Thông tư 12345/2020/TT-BTC và 15-2019-TT-BTC hết hiệu lực."
    docs = spark.createDataFrame([("1/2024/TT-A", "t", "http://x", f"<p>{text}</p>", "")], "number string, title string, url string, html string, fetch_error string")
    got = {r["old_number"] for r in expiry.scan_expired(docs, F.lit(dt.date(2024, 1, 1))).collect()}
    assert got == {"12345/2020/TT-BTC", "15-2019-TT-BTC"}


def test_skipped_reads_count_as_unchanged(spark):
    df = spark.createDataFrame([("a", k, "x") for k in (1, 2, 5)] + [("b", k, f"i{k}") for k in range(1, 13)], "page string, attempt int, item string")
    assert rows(sequences.snapshot_convergence(df, ["page"], "item"), "page", "stop_attempt", "merged_count") == [("a", 4, 1), ("b", None, 8)]
    assert rows(sequences.snapshot_convergence(df, ["page"], "item", max_attempts=20), "page", "merged_count") == [("a", 1), ("b", 12)]


def test_transfer_and_upsert_keep_columns_and_numbers(spark):
    cols = ["id", "number", "title", "field", "doc_type", "url", "department", "impact", "effective_date", "approval_status", "process_status", "status_date"]
    schema = "_row_number long, " + ", ".join(f"{c} string" for c in cols) + ", extra string, size int"
    old = spark.createDataFrame([(7, *["x"] * len(cols), "kept", 5)], schema)
    new = spark.createDataFrame([(1, "9/2020/TT-A", "t"), (2, " ", "lost")], "ord long, number string, title string")
    got = {r["_row_number"]: r for r in register.upsert_protected(old, new, ["number", "title"]).collect()}
    assert got[7]["extra"] == "kept" and got[8]["extra"] == "" and got[8]["size"] is None and got[8]["action"] == "inserted"
    assert [r["ord"] for r in register.rejected_payloads(new).collect()] == [2]
    staging = old.withColumn("number", F.lit("5/2020/TT-B")).withColumn("_row_number", F.lit(2).cast("long"))
    _, moved = register.transfer(staging, old, F.lit("now"))
    assert [(r["_row_number"], r["extra"]) for r in moved.collect()] == [(8, "kept")]


def test_report_blocks(spark):
    from vellum.operators.report_lines import Block, report_lines, run_report

    rows = spark.createDataFrame([(i, f"r{i}") for i in (3, 1, 2, 9)], "ord long, text string")
    text = [F.col("text"), F.when(F.col("ord") == 2, F.concat(F.lit("  more "), F.col("n").cast("string")))]
    blocks = [
        Block(head=["A"]), Block(rows, text, ["ord"], ["list"], [""], cap=3), Block(rows, text, ["ord"]), Block(rows.limit(0), text, ["ord"], ["never"], cap=3),
        Block(rows.limit(0), text, ["ord"], ["always"], cap=3, always=True), Block(rows.limit(0), text, ["ord"], cap=3, otherwise="nothing"),
    ]
    got = [(r["section"], r["line"]) for r in report_lines(spark, blocks).orderBy("section", "ord").collect()]
    assert got == [(1, "A"), (2, "list"), (2, "r1"), (2, "r2"), (2, "  more 2"), (2, "r3"), (2, ""), (3, "r1"), (3, "r2"), (3, "  more 2"), (3, "r3"), (3, "r9"), (5, "always"), (6, "nothing")]
    run = spark.createDataFrame([("t", False)], "created_at string, ok boolean")
    lines = [r["line"] for r in report_lines(spark, run_report(spark, "R", {"run": run})).orderBy("section", "ord").collect()]
    assert L.REPORT_TEXTS["production"] in lines and L.REPORT_TEXTS["conclusion"] in lines and "Kết luận: CHƯA ĐẠT" in lines


# --- texts stand in a plan once -------------------------------------------------------------
def _copies(df, word):
    return df._jdf.queryExecution().optimizedPlan().toString().lower().count(word)


PAYLOAD = "doc_type string, title string, doc_number string, url string, number_on_page string"


def _payload(spark, data):
    """Payload rows without relations; the page says only its number."""
    blank = {c: F.lit("") for c in [*L.OFFICIAL_COLUMNS, "field_name", "field_code", "source_list_url", "mapped_field", "sequence_id", "scanned_at", "basis_text", "basis_hint", "relation_note"]}
    info = F.struct(F.col("number_on_page").alias("number"), *[F.lit("").alias(c) for c in ("title", "doc_type", "effective_date")])
    df = spark.createDataFrame(data, PAYLOAD).withColumns({**blank, "has_relations": F.lit(False), "info": info})
    return documents.build_payload(df, "N")


def test_payload_reads_each_text_once(spark):
    got = _payload(spark, [("Luật", "a  b", " 1/2020/TT-GDĐT ", "u1", "9"), ("", "", "", "u2", "2/2021/nd-cp"), ("", "", "", "u3", None), (None, None, None, None, None)])
    ids = [hashlib.md5(x.encode()).hexdigest()[:16] for x in ("1/2020/TT-GDĐT", "2/2021/nd-cp", "u3")]
    assert rows(got, "url", "id", "number", "title") == [
        ("", "", "", ""), ("u1", ids[0], "1/2020/TT-BGDĐT", "a b"), ("u2", ids[1], "2/2021/NĐ-CP", ""), ("u3", ids[2], "", ""),
    ]
    assert _copies(got, "regexp_replace") <= 40  # was 166


def test_gates_read_each_text_once(spark):
    rules = RuleSet(title_keywords=["cấm", "b"], url_keywords=["x1", "x2"], number_keywords=["/QH", "/zz"])
    df = spark.createDataFrame(
        [("1", "Luật", "ab CẤM", "1", "u"), ("2", "Luật", "", "1/zz", "u/X2"), ("3", "Luật", "", "1/ZZ", "u"), ("4", "Luật", None, None, None), ("5", "Công văn", "công văn", "1", "u")],
        "id string, doc_type string, title string, number string, url string",
    )
    judged = df.select("id", documents.payload_skip_reason(rules).alias("r"))
    assert [r for _, r in rows(judged, "id", "r")] == [
        "exclude_title_keywords:cấm", "exclude_url_keywords:x2", "exclude_so_hieu_keywords:/zz", "", "not_in_accepted_doc_types:Công văn",
    ]
    assert _copies(judged, "regexp_replace") <= 8
    listed = df.select("id", F.array_join(listing.payload_errors(rules), "|").alias("e"))
    assert [e for _, e in rows(listed, "id", "e")][1:3] == ["missing_title|blocked_url_keyword:x2|number_keyword:/ZZ", "missing_title|number_keyword:/ZZ"]


def test_gate_message_reads_each_text_once(spark):
    df = spark.createDataFrame([("1", "Luật", "x VBHN", "1", None), ("2", "Luật", None, "1", "cong-van")], "id string, doc_type string, title string, number string, url string")
    said = df.withColumn("gate_code", documents.write_gate_code()).select("id", documents.write_gate_message().alias("m"))
    assert [m.split(": ")[1] for _, m in rows(said, "id", "m")] == ["vbhn", "cong-van"]
    assert _copies(said, "lower(") <= 4


def test_digest_reads_the_due_date_once(spark):
    cells = [(1, "An | 1/5/2026"), (2, "b"), (None, "c"), (3, "b")]
    data = [(n, f"n{n}", "t", f"T{i}", "", "D | p@x | Hạn hoàn thành: 1/5/2026 | s" if n == 3 else "", "p@x" if n != 3 else c, "2026-05-0%dT17:00:00Z" % (i + 1)) for i, (n, c) in enumerate(cells)]
    df = spark.createDataFrame(data, "_row_number long, number string, title string, task_id string, sync_status string, current_checkpoint string, current_pic string, next_due string")
    side = spark.createDataFrame([(f"T{i}", f"u{i}") for i in range(4)], "task_id string, task_url string")
    alerts = reports.overdue_alerts(df.join(side, "task_id"), F.lit(D(2026, 5, 20)))
    lines = reports.digest_lines(alerts, F.lit(D(2026, 5, 20)), "short")
    got = rows(lines, "pic", "line_ord", "row_ord", "html")
    assert [r[:2] for r in got if r[1] in (-(2**62), 2**62)] == [("p@x", -(2**62)), ("p@x", 2**62)]
    assert "p@x () — 4 task" in got[0][3].replace("</b>", "").replace("(D)", "()") and len(got) == 6
    assert _copies(lines, "gettimestamp") <= 4  # two readings of two spellings: for the heads and for the lines
