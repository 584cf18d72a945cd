"""Streams over small files against their batch rules."""

import datetime as dt
import itertools
import json
import os
import random

import pandas as pd
import pytest

from vellum.operators.sequences import snapshot_convergence
from vellum.sources.snapshots import latest_version, read_snapshot, write_snapshot
from vellum.streaming import requests as R
from vellum.streaming import upsert as U

T0 = dt.datetime(2026, 1, 1, 0, 0, 0)
SCHEMA = "request_id string, arrival_ts timestamp, arrival_s long, raw_timestamp string, body string, ord long"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def request(ord_, rid, at, sent=None, body="b"):
    when = T0 + dt.timedelta(seconds=at)
    epoch = int(when.replace(tzinfo=dt.timezone.utc).timestamp())
    return {"request_id": rid, "arrival_ts": when.strftime("%Y-%m-%dT%H:%M:%SZ"), "arrival_s": epoch,
            "raw_timestamp": str(epoch - (0 if sent is None else sent)) if not isinstance(sent, str) else sent, "body": body, "ord": ord_}


REQUESTS = [
    request(1, "a", 0), request(2, "a", 100), request(3, "b", 120, 400), request(4, "b", 130, -31), request(5, "b", 140, "soon"), request(6, "", 150),
    request(7, "b", 160, body="x" * 50), request(8, "b", 170), request(9, "c", 180, 300), request(10, "a", 2000),
]


def files(tmp_path, name, batches):
    folder = tmp_path / name
    folder.mkdir()
    for i, batch in enumerate(batches):
        path = folder / f"{i}.json"
        path.write_text("\n".join(json.dumps(r) for r in batch))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))  # files are read by age
    return str(folder)


def drain(stream, tmp_path, name, mode="append"):
    query = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
             .option("checkpointLocation", str(tmp_path / f"ck_{name}")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    return stream.sparkSession.table(name)


def test_batch_codes(spark):
    df = spark.createDataFrame([(r["request_id"], r["arrival_s"], r["raw_timestamp"], r["body"], r["ord"]) for r in REQUESTS], "request_id string, arrival_s long, raw_timestamp string, body string, ord long")
    got = {r["ord"]: r["code"] for r in R.request_audit(df, 300, 30, 40).collect()}
    assert got == {1: "", 2: "REPLAY_DETECTED", 3: "TIMESTAMP_EXPIRED", 4: "TIMESTAMP_FUTURE", 5: "INVALID_TIMESTAMP", 6: "MISSING_SIGNATURE_HEADERS",
                   7: "BODY_TOO_LARGE", 8: "", 9: "", 10: ""}


def test_sight_chain_counts_from_the_last_accepted(spark):
    df = spark.createDataFrame([("a", t, t) for t in (0, 200, 400, 600, 701, 701)], "request_id string, arrival_s long, ord long")
    assert sorted(r["arrival_s"] for r in R.accepted_sights(df, 300).collect()) == [0, 400, 701]


def test_one_id_with_a_million_seconds(spark):
    """No array and no window holds an id: its seconds lie in spans, and links are followed in rows."""
    rng = random.Random(4)
    gaps = [rng.choice((1, 1, 2, 3)) if i % 1000 else rng.randint(290, 700) for i in range(1_000_000)]
    frame = pd.DataFrame({"arrival_s": list(itertools.accumulate(gaps))})
    frame["ord"], frame["request_id"] = frame.index, "hot"
    want, last = [], None
    for t in frame["arrival_s"].tolist():
        if last is None or t - last > 300:
            want.append(t)
            last = t
    got = R.accepted_sights(spark.createDataFrame(frame).repartition(8), 300)
    assert sorted(r["arrival_s"] for r in got.collect()) == want


@pytest.mark.parametrize("ttl", [1, 3, 10])
def test_sights_equal_a_plain_fold(spark, ttl):
    rng = random.Random(ttl)
    rows = [(f"r{i % 7}", rng.randint(-60, 60), i) for i in range(300)]
    want = set()
    for rid in {r[0] for r in rows}:
        last = None
        for t, o in sorted((t, o) for r, t, o in rows if r == rid):
            if last is None or t - last > ttl:
                want.add((rid, t, o))
                last = t
    got = R.accepted_sights(spark.createDataFrame(rows, "request_id string, arrival_s long, ord long"), ttl)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert R.accepted_sights(got.limit(0), ttl).count() == 0


@pytest.mark.parametrize("cuts", [1, 4, 11])
def test_replay_stream_equals_audit_for_any_cut(spark, tmp_path, rocks, cuts):
    rng = random.Random(9)
    at, rows = 0, []
    for i in range(80):
        at += rng.choice((0, 1, 5, 40, 200))
        rows.append(request(i, f"r{rng.randint(0, 4)}", at, rng.choice((0, 0, 0, 400))))
    edges = sorted(rng.sample(range(1, 80), cuts - 1))
    folder = files(tmp_path, "cut", [rows[a:b] for a, b in zip([0, *edges], [*edges, 80])])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
    got = {r["ord"] for r in drain(R.audit_stream(stream, 300, 30, 40), tmp_path, f"cut_{cuts}").select("ord").collect()}
    audit = R.request_audit(spark.read.schema(SCHEMA).json(folder), 300, 30, 40)
    assert got == {r["ord"] for r in audit.filter("code = ''").collect()}


def test_replay_stream_equals_batch(spark, tmp_path, rocks):
    # two other requests move the watermark past the expiry of "a" before it is sent again
    between = [[request(11, "d", 1500)], [request(12, "e", 1900)]]
    folder = files(tmp_path, "req", [REQUESTS[:4], REQUESTS[4:9], *between, [REQUESTS[9]]])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
    got = {r["ord"] for r in drain(R.audit_stream(stream, 300, 30, 40), tmp_path, "audit").select("ord").collect()}
    assert got == {1, 8, 9, 10, 11, 12}


def test_daily_once_stream(spark, tmp_path):
    alerts = [{"task_id": t, "event_ts": f"2026-01-0{d}T0{h}:00:00Z"} for t, d, h in [("a", 1, 1), ("a", 1, 5), ("b", 1, 2), ("a", 2, 1), ("a", 2, 1)]]
    folder = files(tmp_path, "al", [alerts[:2], alerts[2:]])
    stream = spark.readStream.schema("task_id string, event_ts timestamp").option("maxFilesPerTrigger", 1).json(folder)
    got = drain(R.daily_once(stream), tmp_path, "daily")
    assert sorted((r["task_id"], str(r["sent_date"])) for r in got.select("task_id", "sent_date").collect()) == [("a", "2026-01-01"), ("a", "2026-01-02"), ("b", "2026-01-01")]


def test_stream_upsert_versions(spark, tmp_path):
    root, cols = str(tmp_path / "reg"), ["number", "title", "field", "doc_type", "url"]
    start = spark.createDataFrame([(2, "1/2020/A1", "t", "", "Luật", "u")], "_row_number long, " + ", ".join(f"{c} string" for c in cols))
    write_snapshot(start, root, 0)
    pay = lambda o, n, t, k="Luật": {"ord": o, "number": n, "title": t, "field": "F", "doc_type": k, "url": "u"}
    folder = files(tmp_path, "pay", [[pay(1, "1/2020/a1", "x"), pay(2, "9/2020/A1", "new")], [pay(3, "9/2020/A1", "newer"), pay(4, "8/2020/A1", "no", "Công văn")]])
    stream = spark.readStream.schema("ord long, " + ", ".join(f"{c} string" for c in cols)).option("maxFilesPerTrigger", 1).json(folder)
    U.stream_upsert(stream, root, cols, str(tmp_path / "ck")).awaitTermination(120)
    assert latest_version(spark, root) == 2
    assert sorted((r["_row_number"], r["number"], r["title"]) for r in read_snapshot(spark, root).collect()) == [(2, "1/2020/a1", "x"), (3, "9/2020/A1", "newer")]
    again = U.upsert_batch(root, cols, stream=str(tmp_path / "ck"))
    again(spark.createDataFrame([(9, "7/2020/A1", "late", "", "Luật", "u")], "ord long, " + ", ".join(f"{c} string" for c in cols)), 1)
    assert latest_version(spark, root) == 2 and read_snapshot(spark, root).count() == 2
    # another checkpoint starts with batch 0 and goes on from version 2; what is kept out is handed on
    out = []
    late = spark.createDataFrame([(9, "7/2020/A1", "late", "F", "Luật", "u"), (10, " ", "none", "F", "Luật", "u")], "ord long, " + ", ".join(f"{c} string" for c in cols))
    U.upsert_batch(root, cols, stream="other", rejected=lambda df, b: out.extend(df.select("ord", "action").collect()))(late, 0)
    assert latest_version(spark, root) == 3 and read_snapshot(spark, root).count() == 3
    assert [tuple(r) for r in out] == [(10, "rejected")]


def test_convergence_stream_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    reads = [{"page": p, "attempt": k, "item": i} for p, k, i in [(1, 1, "x"), (1, 2, "x"), (2, 1, "a"), (2, 2, "b"), (1, 3, "x"), (1, 4, "x"), (2, 3, "c"), (2, 4, "d"), (2, 5, "a"), (2, 6, "b"), (1, 5, "z")]]
    folder = files(tmp_path, "reads", [reads[:4], reads[4:8], reads[8:]])
    schema = "page long, attempt int, item string"
    got = drain(U.convergence_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)), tmp_path, "conv")
    want = snapshot_convergence(spark.read.schema(schema).json(folder), ["page"], "item").filter("converged")
    pick = lambda df: sorted((r["page"], r["stop_attempt"], r["merged_count"]) for r in df.collect())
    assert pick(got) == pick(want) == [(1, 4, 1), (2, 6, 4)]


def test_convergence_stream_counts_skipped_and_split_reads(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    read = lambda p, k, i: {"page": p, "attempt": k, "item": i}
    reads = [[read(1, 1, "x"), read(1, 2, "x"), *[read(2, k, i) for k, i in [(1, "a"), (2, "b"), (3, "c"), (4, "a")]]], [read(1, 5, "x"), read(2, 4, "b")], [read(2, 4, "c")]]
    folder = files(tmp_path, "skip", reads)
    schema = "page long, attempt int, item string"
    got = drain(U.convergence_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)), tmp_path, "skips")
    want = snapshot_convergence(spark.read.schema(schema).json(folder), ["page"], "item").filter("converged")
    pick = lambda df: sorted((r["page"], r["stop_attempt"], r["merged_count"]) for r in df.collect())
    assert pick(got) == pick(want) == [(1, 4, 1)]


def test_convergence_stream_stops_at_the_expected_number(spark, tmp_path, rocks):
    """A page that reaches its announced number stops at once, as in the batch rule."""
    rng = random.Random(3)
    reads = [
        {"page": p, "attempt": k, "item": f"i{rng.randint(0, 9)}", "n": (0, 3, 5, 99)[p % 4]} for k in range(1, 9) for p in range(12) for _ in range(rng.randint(0, 3))
    ]
    by_attempt = [[r for r in reads if r["attempt"] == k] for k in range(1, 9)]
    folder = files(tmp_path, "exp", [by_attempt[0], [*by_attempt[1], *by_attempt[2]], *by_attempt[3:]])
    schema = "page long, attempt int, item string, n long"
    got = drain(U.convergence_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder), expected="n"), tmp_path, "exp")
    want = snapshot_convergence(spark.read.schema(schema).json(folder), ["page"], "item", expected="n").filter("converged")
    pick = lambda df: sorted((r["page"], r["stop_attempt"], r["merged_count"]) for r in df.collect())
    assert pick(got) == pick(want) and any(r[1] < 4 for r in pick(want))


def test_daily_once_takes_the_local_day(spark, tmp_path):
    alerts = [{"task_id": "a", "event_ts": f"2026-01-01T{t}:00Z"} for t in ("16:30", "16:45", "17:30")]
    stream = spark.readStream.schema("task_id string, event_ts timestamp").json(files(tmp_path, "local", [alerts]))
    got = drain(R.daily_once(stream), tmp_path, "local_day")
    assert sorted(str(r["sent_date"]) for r in got.collect()) == ["2026-01-01", "2026-01-02"]
