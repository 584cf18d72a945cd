"""Readers, writers and snapshots on files of a temporary folder."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.operators.register import upsert_protected
from vellum.sources import config, files, snapshots
from vellum.sources.buckets import read_manifest, row_bucket, touched_buckets
from vellum.sources.missing_store import read_history, read_missing, write_missing_snapshot
from vellum.sources.snapshots import latest_version, read_snapshot, upsert_version, write_snapshot


def dump(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_scan_config(spark, tmp_path):
    path = dump(tmp_path / "c.json", {"run_mode": "all", "page_size": 50, "filters": {"doc_type_ids_to_crawl": [21, 11], "accepted_doc_types": ["Luật "], "exclude_url_keywords": ["X;", "vbhn"]}})
    rules = config.read_scan_config(spark, path)
    assert (rules.run_mode, rules.page_size, rules.doc_type_ids, rules.accepted) == ("all", 50, ["21", "11"], ["Luật"])
    assert rules.blocked_url_keywords == [*L.BLOCKED_URL_KEYWORDS, "x"] and rules.skipped == L.SKIPPED_DOC_TYPES
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        config.read_scan_config(spark, str(tmp_path / "none.json"))


def test_listing_result_and_debug(spark, tmp_path):
    doc = {"ma_linh_vuc": "thue", "url": "u1", "title_from_list": "t", "doc_type_from_list": "Luật", "doc_number_from_list": "1"}
    page = {"page_index": 1, "url": "p", "document_count": 1}
    field = {"ma_linh_vuc": "thue", "documents": [doc], "pages_crawled": [page], "filter_debug_stats": {"input_links": 3}}
    path = dump(tmp_path / "l.json", {"documents": [doc, {**doc, "url": "u2"}], "fields": [field, {"ma_linh_vuc": "x", "documents": [], "pages_crawled": []}]})
    frames = files.read_listing_result(spark, path)
    assert {r["url"] for r in frames["documents"].collect()} == {"u1", "u2"} and "doc_number" in frames["documents"].columns
    assert sorted((r["branch"], r["document_count"], r["page_count"]) for r in frames["fields"].collect()) == [(0, 1, 1), (1, 0, 0)]
    assert frames["fields"].filter("branch = 0").first()["filter_debug_stats"] == {"input_links": 3} and frames["pages"].count() == 1
    assert files.read_listing_debug(spark, str(tmp_path / "none.json")).count() == 0
    debug = dump(tmp_path / "d.json", {"fields": [{"ma_linh_vuc": "thue", "debug_pages": [{"page_index": 1, "page_documents": []}]}]})
    assert files.read_listing_debug(spark, debug).first()["field_code"] == "thue"


def test_payload_batch(spark, tmp_path):
    path = dump(tmp_path / "b.json", {"dry_run": True, "payloads": [{"Số hiệu": "1", "Tên văn bản": "t"}], "results": [{"url": "u", "status": "sent", "result": {"ok": True}}], "rows": [{"url": "u"}]})
    frames = files.read_payload_batch(spark, path)
    assert frames["payloads"].first()["number"] == "1" and json.loads(frames["results"].first()["result"]) == {"ok": True} and frames["rows"].count() == 1
    assert files.read_payload_batch(spark, str(tmp_path / "none.json"))["results"].count() == 0


def test_register_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("_rowNumber,Số hiệu,Khác\n2,1/2020/A1,z\n3,,z\n", encoding="utf-8")
    df = files.read_register(spark, str(tmp_path / "r.csv"))
    assert df.columns == ["_row_number", *L.SHEET_LABELS] and [(r["_row_number"], r["number"], r["title"]) for r in df.orderBy("_row_number").collect()] == [(2, "1/2020/A1", ""), (3, "", "")]


def test_field_entries_and_unknown_filters(spark, tmp_path):
    one = {"enabled": True, "ma_linh_vuc": ["a", " b "], "ten_linh_vuc": "A", "list_url": "u", "filters": {"doc_type_ids_to_crawl": ["21"]}}
    path = dump(tmp_path / "c.json", one)
    row = config.read_field_rows(spark, path).first()
    assert (row["enabled"], row["field_codes"], row["field_names"], row["doc_type_ids"]) == (True, ["a", "b"], ["A"], ["21"])
    listed = dump(tmp_path / "d.json", {"own": [one, {**one, "enabled": "true"}, 7]})
    assert [r["enabled"] for r in config.read_field_rows(spark, listed, fields_key="own").orderBy("ord").collect()] == [True, False]
    assert config.expand_fields(config.read_field_rows(spark, listed, "own")).count() == 1
    other = dump(tmp_path / "e.json", {"filters": {"my_fields": ["x"]}})
    with pytest.raises(ValueError, match="my_fields"):
        config.read_scan_config(spark, other)
    assert config.read_scan_config(spark, other, "my_fields").required_fields == ["x"]


def test_unreadable_files_and_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    dump(tmp_path / "in" / "a.json", {"documents": [{"url": "u1"}], "fields": []})
    dump(tmp_path / "in" / "b.json", {"documents": {"url": "u2"}, "fields": []})
    dump(tmp_path / "in" / "c.json", [1])
    (tmp_path / "in" / "d.json").write_text('{"documents": [')
    (tmp_path / "in" / "e.json").write_text(" ")
    frames = files.read_listing_result(spark, str(tmp_path / "in"))
    assert [r["url"] for r in frames["documents"].collect()] == ["u1"]
    reasons = {r["source"][-6:]: r["reason"] for r in frames["quarantine"].collect()}
    assert reasons == {"b.json": "wrong type: documents", "c.json": "not an object", "d.json": "not JSON", "e.json": "blank"}
    batch = dump(tmp_path / "b.json", {"payloads": [{"Số hiệu": "1"}, 7], "results": []})
    assert [r["reason"] for r in files.read_payload_batch(spark, batch)["quarantine"].collect()] == ["wrong type: payloads"]
    inside = spark.createDataFrame([('{"results": [{"url": "u", "send_attempt": "many"}]}',), ('{"results": [{"url": "u", "send_attempt": 2}]}',)], "text string")
    assert sorted(r["_fault"] or "" for r in files.batch_rows(inside).collect()) in (["", "wrong type inside"], ["", "wrong type: results"])
    (tmp_path / "r.csv").write_text('_rowNumber,Số hiệu,Tên văn bản\n2,1/2020/A1,"a ""b"",\nc"\nx,2/2020/A1,t\n4,3\n', encoding="utf-8")
    path = str(tmp_path / "r.csv")
    assert [(r["_row_number"], r["title"]) for r in files.read_register(spark, path).collect()] == [(2, 'a "b",\nc')]
    assert sorted(r["reason"] for r in files.register_quarantine(spark, path).collect()) == ["cells do not match the header", "no row number"]
    (tmp_path / "n.csv").write_text("Số hiệu\n1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="_rowNumber"):
        files.read_register(spark, str(tmp_path / "n.csv"))


def test_sheet_columns(spark, tmp_path):
    assert files.sheet_columns(spark) == list(L.SHEET_LABELS.values())
    assert files.sheet_columns(spark, dump(tmp_path / "o.json", {"sheet_columns": ["A ", "", "B"]})) == ["A", "B"]
    assert files.sheet_columns(spark, dump(tmp_path / "a.json", ["C"])) == ["C"]
    (tmp_path / "bad.json").write_text("{")
    assert files.sheet_columns(spark, str(tmp_path / "bad.json")) == files.sheet_columns(spark, str(tmp_path / "none.json")) == list(L.SHEET_LABELS.values())


def test_previous_snapshot(spark, tmp_path):
    assert files.read_previous_snapshot(spark, None).count() == 0
    assert files.read_previous_snapshot(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "s.json").write_text('{"key":"a","number":"A","count":1}\n{broken\n')
    assert [r["key"] for r in files.read_previous_snapshot(spark, str(tmp_path / "s.json")).collect()] == ["a"]


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("PC", 2, 1, 50.0), ("KT", 1, 0, 0.0)], "department string, total long, overdue long, overdue_percent double")
    files.write_report_csv(rows.orderBy(F.desc("overdue")), "slow_departments", str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["Bộ phận", "Tổng việc", "Việc quá hạn", "Tỷ lệ quá hạn (%)"] and back.count() == 2
    files.write_report_json(rows, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    lines = spark.createDataFrame([(2, 1, "c"), (1, 2, "b"), (1, 1, "a")], "section int, ord int, line string")
    files.write_text_report(lines, str(tmp_path / "txt"))
    texts = [p.read_text() for p in sorted((tmp_path / "txt").glob("part-*"))]
    assert "".join(texts) == "a\nb\nc\n"


def test_history_and_log_append(spark, tmp_path):
    row = spark.createDataFrame([(1, 2)], "a int, b int")
    for _ in range(2):
        files.append_history(row, str(tmp_path / "h"))
        files.append_event_log(row, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "h")).count() == spark.read.parquet(str(tmp_path / "e")).count() == 2


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "reg")
    assert snapshots.latest_version(spark, root) is None
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, root)
    snapshots.write_snapshot(spark.range(3), root, 0)
    snapshots.write_snapshot(spark.range(5), root, 1)
    snapshots.write_snapshot(spark.range(9), root, 1)
    assert snapshots.latest_version(spark, root) == 1 and snapshots.read_snapshot(spark, root).count() == 5 and snapshots.read_snapshot(spark, root, 0).count() == 3


def test_pages_and_issues(spark, tmp_path):
    spark.createDataFrame([(1, "u", "<p>", 9)], "page_id long, url string, html string, x int").write.parquet(str(tmp_path / "p"))
    assert files.read_pages(spark, str(tmp_path / "p")).columns == ["page_id", "url", "html"]


def test_state_partitions(spark, tmp_path):
    import datetime as dt

    from vellum.operators.reports import save_state

    path = str(tmp_path / "state")
    first = spark.createDataFrame([(dt.date(2026, 5, 1), "a"), (dt.date(2026, 5, 2), "b")], "sent_date date, task_id string")
    save_state(first, path)
    save_state(spark.createDataFrame([(dt.date(2026, 5, 2), "c")], first.schema), path)
    assert sorted(r["task_id"] for r in spark.read.parquet(path).collect()) == ["a", "c"]


def _numbered(spark, n):
    row = F.col("id")
    return spark.range(n).select(
        (row + 2).alias("_row_number"), F.when(row % 1000 == 7, "").otherwise(F.concat(row.cast("string"), F.lit("/2020/TT-BTC"))).alias("number"),
        F.lit("old").alias("title"), F.lit("").alias("field"),
    )


PAYLOADS = "ord long, number string, title string, field string"


def test_ten_payloads_rewrite_at_most_ten_buckets(spark, tmp_path):
    root = str(tmp_path / "reg")
    write_snapshot(_numbered(spark, 1_000_000), root, 0)
    start = spark.createDataFrame([(1, "5/2020/TT-BTC", "a", "f")], PAYLOADS)
    assert upsert_version(start, root, ["number", "title", "field"], buckets=128) == 1  # deals the whole register once
    ten = spark.createDataFrame([(i, f"{i * 99991}/2020/tt - btc", "new", "") for i in range(8)] + [(8, "x1/2020/Q", "n", ""), (9, "x2/2020/Q", "n", "")], PAYLOADS)
    assert upsert_version(ten, root, ["number", "title", "field"]) == 2
    manifest = read_manifest(spark, root, 2)
    assert sum(m["version"] == 2 for m in manifest) <= 10 and len(manifest) == 128
    written = [p for p in (tmp_path / "reg" / "data" / "v2").iterdir() if p.name.startswith("_bucket=")]
    assert len(written) <= 10
    now = read_snapshot(spark, root)
    assert now.count() == 1_000_002 and now.filter("title = 'new'").count() == 8
    assert [(r["_row_number"], r["number"]) for r in now.filter("title = 'n'").orderBy("_row_number").collect()] == [(1_000_002, "x1/2020/Q"), (1_000_003, "x2/2020/Q")]
    assert read_snapshot(spark, root, 1).filter("title = 'new'").count() == 0  # older versions stand


def test_buckets_equal_one_upsert_and_keep_empty_batches(spark, tmp_path):
    root, columns = str(tmp_path / "reg"), ["number", "title", "field"]
    register = _numbered(spark, 2000)
    write_snapshot(register, root, 0)
    rows = [(i, f"{(i * 7) % 2500}/2020/TT-BTC", f"t{i}", "" if i % 3 else f"f{i}") for i in range(900)] + [(900, " ", "none", "")]
    whole = upsert_protected(register, spark.createDataFrame(rows, PAYLOADS), columns).drop("action")
    for a in range(0, 901, 300):
        upsert_version(spark.createDataFrame(rows[a : a + 300], PAYLOADS), root, columns, buckets=16)
    upsert_version(spark.createDataFrame([], PAYLOADS), root, columns)
    pick = lambda df: sorted(map(tuple, df.select("_row_number", *columns).collect()))
    assert latest_version(spark, root) == 5 and pick(read_snapshot(spark, root)) == pick(whole)


def test_rows_and_payloads_agree_on_the_bucket(spark):
    numbers = ["1/2020/TT-BTC", " 1 / 2020/tt-btc ", "", None, "---", "  - - ", "12\u00a0/2021/QĐ"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "_row_number long, number string")
    own = {r["_row_number"]: r["b"] for r in rows.select("_row_number", row_bucket(64).alias("b")).collect()}
    for i, n in enumerate(numbers):
        found = touched_buckets(spark.createDataFrame([(n,)], "number string"), 64)
        assert (own[i] in found) if (n or "").strip() else found == []


def test_missing_store_rebuilds_any_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("vellum.sources.missing_store.BASE_EVERY", 3)
    root = str(tmp_path / "missing")
    runs = {f"2026-01-0{d}": {k: (k * d if k == 4 else k) for k in range(10) if (k + d) % 3 or k == 4} for d in range(1, 9)}
    runs["2026-01-05"] = {}
    rows = [(d, f"K{k}", f"N{k}", n) for d, keys in runs.items() for k, n in keys.items()]
    frame = spark.createDataFrame(rows, "run string, key string, number string, count long")
    days = spark.createDataFrame([(d,) for d in runs], "run string")
    write_missing_snapshot(frame.filter("run <= '2026-01-04'"), root, "run")  # several runs at once
    for day in sorted(runs)[4:]:  # then one by one; a run without keys is named
        write_missing_snapshot(frame.filter(F.col("run") == day), root, "run", days.filter(F.col("run") == day))
    write_missing_snapshot(frame, root, "run", days)  # nothing new
    history = {r["version"]: r for r in read_history(spark, root).collect()}
    assert len(history) == 8
    for version, day in enumerate(sorted(runs), 1):
        want = sorted((f"K{k}", f"N{k}", n) for k, n in runs[day].items())
        assert sorted(tuple(r) for r in read_missing(spark, root, version).select("key", "number", "count").collect()) == want
        before = set(runs[sorted(runs)[version - 2]]) if version > 1 else set()
        now = set(runs[day])
        r = history[version]
        assert (r["run_ts"], r["current_missing"], r["previous_missing"]) == (day, len(now), len(before))
        assert (r["new_missing"], r["resolved_missing"], r["persistent_missing"]) == (len(now - before), len(before - now), len(now & before))
        assert r["net_delta"] == len(now) - len(before)
    stored = spark.read.parquet(f"{root}/changes")
    assert stored.filter("state = 'new'").count() == sum(r["new_missing"] for r in history.values())
    assert stored.filter("version = 2 and key = 'K4'").first()["state"] == "changed"
    assert stored.filter("version = 2 and key = 'K0'").count() == 0  # as it was: not written
    assert read_missing(spark, str(tmp_path / "none")) is None


def test_state_reads_only_the_kept_dates(spark, tmp_path):
    from vellum.operators.reports import keep_newest_dates, merge_state, save_state

    start, path = dt.date(2026, 1, 1), str(tmp_path / "state")
    rows = [(start + dt.timedelta(days=d), f"T{t}", "p", d) for d in range(40) for t in range(2)]
    save_state(spark.createDataFrame(rows, "sent_date date, task_id string, pic string, days int"), path)
    state = spark.read.parquet(path)
    today = spark.createDataFrame([(5, "T0", "q", 9), (6, "T7", "q", 8)], "_row_number long, task_id string, pic string, days_overdue int")
    merged = merge_state(state, today, F.lit(start + dt.timedelta(days=39)), 5)
    got = sorted((str(r["sent_date"]), r["task_id"], r["pic"]) for r in merged.collect())
    days = [str(start + dt.timedelta(days=d)) for d in range(35, 40)]
    assert got == sorted([(d, t, "p") for d in days for t in ("T0", "T1") if (d, t) != (days[-1], "T0")] + [(days[-1], "T0", "q"), (days[-1], "T7", "q")])
    assert keep_newest_dates(state, "sent_date", 3).count() == 6 and keep_newest_dates(state.limit(0), "sent_date").count() == 0
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    whole = merged._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sent_date" in whole and "subquery" in whole.split("PartitionFilters: [isnotnull(sent_date")[1][:200]
