"""Scalar expressions on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vellum.functions import dates, html, jsonx, tasks, text, urls


def test_clean_and_normalize(value):
    rows = [None, "", "  \t a  \n", "a  \t b\n\n\nc ", "   "]
    assert value(text.clean_text, rows) == ["", "", "a", "a  \t b\n\n\nc", ""]
    assert value(text.normalize_text, rows) == ["", "", "a", "a b\nc", ""]


def test_number_extraction(value):
    rows = ["Thông tư 01/2020/TT-BGDĐT.", "số 12/2021/NĐ-CP, 3/2020/QH15;", "x12/2020/TT-A", "12345/2020/TT-A", "ngày 01/02/2020", ""]
    assert value(text.document_number, rows) == ["01/2020/TT-BGDĐT", "12/2021/NĐ-CP", "", "", "", ""]
    assert value(text.document_numbers, rows)[1] == ["12/2021/NĐ-CP", "3/2020/QH15"]


def test_number_keys(value):
    same = ["01/2020/TT-BGDĐT", "01 / 2020 / TT-BGDDT", "01/2020/tt–bgdđt.", "01/2020/TT−BGDĐT", "01/2020/TT-BGDD́T"]
    assert set(value(text.match_key, same)) == {"01/2020/TTBGDDT"}
    assert value(text.match_key, ["ế", "ế", "", None]) == ["E", "E", "", ""]
    assert value(text.tracking_key, ["12/2020/NĐ – CP.", " đ "]) == ["12/2020/ND-CP", "D"]


def test_canonical_number(value):
    rows = ["1 / 2020 / tt - bgddt", "2/2020/NDCP", "2/2020/nđ - cp", "3/2020/QH 15", "TT-BGD", "4/TT-BGD", "5/2020/TT-BTC"]
    assert value(text.canonical_number, rows) == [
        "1/2020/TT-BGDĐT", "2/2020/NĐ-CP", "2/2020/NĐ-CP", "3/2020/QH15", "TT-BGD", "4/TT-BGD", "5/2020/TT-BTC",
    ]


def test_primary_number(value):
    rows = ["Luật 1/2019/QH14 và Nghị định số 2/2020/NĐ-CP", "Nghị định 2/2020/nđ-cp", "không có"]
    assert value(text.primary_number, rows) == ["2/2020/NĐ-CP", "2/2020/NĐ-CP", ""]


def test_document_type(value):
    rows = ["12. Thông tư liên tịch 1", "thông tư 1", "Về Bộ luật Lao động", "luật nghị định", "Kỹ thuật", "Luật sư", "", "a nghị định; b bộ luật"]
    assert value(text.document_type, rows) == ["Thông tư liên tịch", "Thông tư", "Bộ luật", "Luật", "", "Luật", "", "Bộ luật"]


def test_headings_and_status(value):
    rows = ["Văn bản căn cứ (12)", "VĂN BẢN  HƯỚNG DẪN", "Văn bản được hướng dẫn (1)", "van ban sua doi bo sung", "Khác (2)"]
    assert value(text.canonical_heading, rows) == [
        "Văn bản căn cứ", "Văn bản hướng dẫn", "Văn bản được hướng dẫn", "Văn bản sửa đổi, bổ sung", "Khác",
    ]
    assert value(text.relation_status, ["Lỗi quét ", "?", None]) == ["Lỗi quét", "Đã gợi ý", "Đã gợi ý"]


def test_lists(value):
    assert value(text.split_values, ["a, b;\n a;; c\r\nb", None, " ; "]) == [["a", "b", "c"], [], []]


def test_percent(spark):
    rows = spark.createDataFrame([(0, 0), (1, 32), (107, 4000), (1, 3), (2, 3), (5, 5)], "n long, d long")
    got = [r[0] for r in rows.select(text.percent("n", "d", 100.0)).collect()]
    assert got == [100.0, 3.13, 2.68, 33.33, 66.67, 100.0]


def test_ids(value):
    assert value(text.sequence_id, ["7", "174", "12345"]) == ["VB007", "VB174", "VB12345"]
    assert value(lambda x: text.stable_id(x, F.lit("")), [""]) == [""]


def test_keywords(value):
    assert value(text.clean_keyword, [" Ke-Hoach; "]) == ["ke-hoach"]
    assert value(text.clean_path_token, ["/Giao-Duc/; "]) == ["giao-duc"]
    assert value(lambda x: text.first_hit(x, ["b", "a"]), ["ab", "a", "c"]) == ["b", "a", None]
    assert value(lambda x: text.contains_any(x, ["a.b", "(c"]), ["xa.b", "axb", "(c"]) == [True, False, True]


def test_urls(value):
    rows = ["https://A.vn/x/#f", "HTTPS://a.vn/x?", "//a.vn/x", "a/b", "mailto:x", None]
    assert value(urls.normalize_url, rows) == ["https://A.vn/x", "https://a.vn/x", "", "", "", ""]
    assert value(urls.url_path, ["https://a.vn/Giao-Duc/x.html?q#f", "/b/c", "::bad::"]) == ["/giao-duc/x.html", "/b/c", "::bad::"]
    edit = lambda x: urls.set_query_param(x, "k", "a b")
    assert value(edit, ["http://a/?x=%2C&k=1&y=#f", "http://a/", "http://a/?k=1&x=2&k=3"]) == [
        "http://a/?x=%2C&k=a+b&y=", "http://a/?k=a+b", "http://a/?k=a+b&x=2",
    ]
    page = lambda x: urls.build_page_url(x, F.lit(3), 20)
    assert value(page, ["http://a/?PageIndex=9&b=1&PageSize=5"]) == ["http://a/?b=1&PageSize=20&PageIndex=3"]


def test_document_url(value):
    test = lambda x: urls.is_document_url(x, "docs.example.org")
    rows = [
        "https://docs.example.org/thue/luat-12-d1.html#x", "https://www.docs.example.org/a-1-d22.html", "https://docs.example.org/van-ban-moi.html",
        "https://docs.example.org/danh-sach-1-d2.html", "https://other.example.org/a-1-d2.html", "https://docs.example.org/a-1-d2.html?x=1",
    ]
    assert value(test, rows) == [True, True, False, False, False, False]


def test_path_filter(value):
    keep = lambda x: urls.url_path_filter(x, ["/giao-duc/"], ["thue"])
    assert value(keep, ["http://a/giao-duc/x", "http://a/giao-duc-x/", "http://a/thue/giao-duc/", "http://a/GIAO-DUC"]) == [True, False, False, True]
    coded = lambda x: urls.url_path_filter(x, [], [], F.lit("thue"))
    assert value(coded, ["http://a/thue/1", "http://a/x"]) == [True, False]


def test_resolve(spark):
    rows = [("http://h/a/b?q", h) for h in ["/x", "y", "?z", "#f", "//o/p", "https://k/", ""]]
    df = spark.createDataFrame(rows, "b string, h string")
    assert [r[0] for r in df.select(urls.resolve_url("b", "h")).collect()] == [
        "http://h/x", "http://h/a/y", "http://h/a/b?z", "http://h/a/b?q#f", "http://o/p", "https://k/", "http://h/a/b?q",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Ho_Chi_Minh"])
def test_dates_do_not_depend_on_the_session_zone(spark, value, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = ["3/7/2026", "03/07/2026", "31/02/2026", "01/01/26", "2026-05-18", "2026-05-18T17:00:00.000Z", "2026-05-18T01:00:00+09:00", "2026-05-18T23:30:00", "text", "", None]
        day = dt.date
        assert value(dates.parse_date_value, rows) == [
            day(2026, 7, 3), day(2026, 7, 3), None, None, day(2026, 5, 18), day(2026, 5, 19), day(2026, 5, 17), day(2026, 5, 18), None, None, None,
        ]
        assert value(dates.parse_date_flexible, rows[5:6] + ["5/6/2020 7:8:9"]) == [day(2026, 5, 18), day(2020, 6, 5)]
        assert value(dates.due_utc, ["3/7/2026", "x"]) == ["2026-07-03T10:00:00Z", ""]
        assert value(dates.parse_cleanup_time, ["1/2/2023 3:4", "1/2/2023", "2023-02-01T00:00:00Z", "?"]) == [
            dt.datetime(2023, 2, 1, 3, 4), dt.datetime(2023, 2, 1), dt.datetime(2023, 2, 1, 7), None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_date_text(value):
    assert value(dates.format_effective_date, ["3/7/2026", "2026-05-18T17:00:00Z", "khi có"]) == ["03/07/2026", "19/05/2026", "khi có"]
    got = value(dates.latest_date_text, ["từ 1/2/2020 đến 01-03-2021, không 31/02/2022", "không"])
    assert [g["spelling"] for g in got] == ["01-03-2021", ""]
    assert got[0]["day"] == dt.date(2021, 3, 1)


def test_next_due(spark):
    row = spark.range(1).select(dates.next_due(F.lit(dt.date(2024, 2, 28)), 2), dates.next_due(F.lit(dt.date(2024, 1, 1)), fixed="5/6/2024")).first()
    assert list(row) == [dt.date(2024, 3, 1), dt.date(2024, 6, 5)]
    with pytest.raises(ValueError):
        dates.next_due(F.lit(None))


def test_html(value, spark):
    page = "<html><head><title> T &amp; t </title><script>x<1</script></head><body><p>a&nbsp;b</p><p>c<br/>d</p></body></html>"
    assert value(html.html_to_text, [page]) == ["T & t a b c d"]
    assert value(html.html_lines, [page]) == [["T & t", "a b", "c", "d"]]
    assert value(html.page_title, [page]) == ["T & t"]
    total = [" Có tất cả 1.234 văn bản", "tìm thấy 5,6 VĂN BẢN", "7 văn bản mới", "không"]
    assert value(html.announced_total, total) == [1234, 56, 7, 0]
    kind = lambda x: html.classify_page(F.lit(""), x)
    assert value(kind, ["", "Lỗi 404", "Dữ liệu đang cập nhật", "nội dung"]) == ["error_or_empty", "error_or_empty", "updating", "ok"]


def test_json(value, spark):
    body = '{"token": "a\\"b", "x": {"Password" : 12, "k": 1}, "session":null, "tokens": "t"}'
    assert value(jsonx.redact_json, [body]) == ['{"token": "[REDACTED]", "x": {"Password" : "[REDACTED]", "k": 1}, "session":"[REDACTED]", "tokens": "t"}']
    typed = spark.createDataFrame([((("a", 1), [("s", 2)]),)], "d struct<p:struct<token:string,k:int>,l:array<struct<secret:string,n:int>>>")
    row = typed.select(jsonx.redact_struct("d", typed.schema["d"].dataType).alias("d")).first()["d"]
    assert (row["p"]["token"], row["p"]["k"], row["l"][0]["secret"], row["l"][0]["n"]) == ("[REDACTED]", 1, "[REDACTED]", 2)
    assert value(lambda x: jsonx.log_text(x, 3), ["abcd", "abc"]) == ["abc\n...<trimmed_to_prevent_error>", "abc"]


def test_envelopes(spark):
    bodies = ['[{"a":1}, 5, {"a":2}]', '{"data":[{"a":1}]}', '{"result":[{"a":1}]}', '{"result":{"data":[{"a":3}]}}', '{"data":{"data":[{"a":4}]}}', "broken", '{"data":"x"}']
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    count = lambda nested: {r["i"]: r["n"] for r in jsonx.unwrap_records(df, "body", ["i"], nested).groupBy("i").agg(F.count("*").alias("n")).collect()}
    assert count(False) == {0: 2, 1: 1, 2: 1, 3: 1}
    assert count(True) == {0: 2, 1: 1, 2: 1, 3: 1, 4: 1}


def test_checklists(value):
    rows = ["PC | a@x | Hạn hoàn thành: 3/5/2026 | Bước | hai ", "PC | a@x | DueDay: 03/05/2026 | Bước", "a | b | c", "", None]
    got = value(tasks.parse_checklist_title, rows)
    assert list(got[0]) == ["PC", "a@x", "3/5/2026", "Bước | hai"]
    assert list(got[1]) == ["PC", "a@x", "", "Bước"] and got[2:] == [None, None, None]
    items = value(tasks.parse_checklist_item, rows)
    assert list(items[0]) == ["PC", "a@x", "3/5/2026", "Bước"] and items[1]["due_text"] == "03/05/2026" and items[2] is None


def test_task_texts(value, spark):
    long = "x" * 400
    title = value(lambda x: tasks.task_title(F.lit("1/2020/A"), x), [long, "tên"])
    assert len(title[0]) == 255 and title[0].endswith("…") and title[1] == "[1/2020/A] tên"
    assert value(tasks.reference_key, ["http://a.b/%@#"]) == ["http%3A//a%2Eb/%25%40%23"]
    assert len(value(lambda x: tasks.reference_alias(x, F.lit("u")), [long])[0]) == 100
    assert value(lambda x: tasks.checklist_title_ok(x), ["a" * 100, "a" * 101]) == [True, False]
    assert [a["level"] for a in value(lambda x: tasks.alert_level(x.cast("int")), ["1", "3", "6", "7"])] == ["info", "warning", "warning", "critical"]
    with pytest.raises(Exception, match="differ in length"):
        spark.range(1).select(tasks.assignees(F.lit("a,b"), F.lit("a"), F.lit("x,y"))).collect()


def test_entities_and_unquoted_links(value, spark):
    texts = ["Ngh&#7883; &#272;&#x1ECB;nh N&#272;-CP", "&eacute;&nbsp;&amp;lt; &unknown; &#99999999; &#xD800;", "a & b", None]
    assert value(html.unescape, texts) == ["Nghị Định NĐ-CP", "é\u00a0&lt; &unknown; &#99999999; &#xD800;", "a & b", None]
    page = "<a href=/x.html>one</a><a class='c' href = '/y'>t&#119;o</a><A HREF=\"/z\" >three</A>"
    pages = spark.createDataFrame([(1, "https://a.vn/p", page)], "page_id long, url string, html string")
    got = [tuple(r) for r in html.html_links(pages, ["page_id"]).orderBy("ord").select("url", "text").collect()]
    assert got == [("https://a.vn/x.html", "one"), ("https://a.vn/y", "two"), ("https://a.vn/z", "three")]


def test_redaction_of_objects_and_lists(value):
    texts = [
        '{"token":{"a":"S1"},"cookies":["S2"],"session":{"id":"S3"},"n":1.50}',
        '{"x":[{"Token":["S4",{"b":"S5"}]}]}', 'no json "token": {"a": "S6"', '{"token":"S7","k":true}', None,
    ]
    got = value(jsonx.redact_json, texts)
    assert not any("S" + str(n) in (t or "") for n in range(1, 8) for t in got)
    assert got[0].endswith('"n":1.50}') and got[3].endswith('"k":true}') and got[4] is None


def test_redaction_reads_brackets_and_strings(value):
    """No Python is run; brackets in strings do not count, and long lists are one pass."""
    items = ",".join(f'{{"id":{i},"v":"]}}\\""}}' for i in range(30_000))
    deep = '"x"'
    for _ in range(25):
        deep = f"[{deep}]"
    texts = [
        '{"token":{"a":"}]","b":[1,{"c":"\\\\"}]},"k":[1, 2]}', f'{{"session":[{items}],"k":1}}', f'{{"token":{deep},"k":1}}',
        '{"a":[{"COOKIE" : [ ] , "k":null}, {"secret":{}}]}', '{"note":"\\"token\\": {\\"a\\":1}"}', "", f'{{"k":[{items}]}}',
    ]
    got = value(jsonx.redact_json, texts)
    assert got[:2] == ['{"token":"[REDACTED]","k":[1, 2]}', '{"session":"[REDACTED]","k":1}']
    assert got[2] == '{"token":"[REDACTED]"' and got[3] == '{"a":[{"COOKIE" : "[REDACTED]" , "k":null}, {"secret":"[REDACTED]"}]}'
    assert got[4:] == texts[4:]


def test_event_log_runs_without_python(spark):
    from vellum.plans import QUERIES

    plan = QUERIES["event_log"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
