"""Conversation repair against a plain search over all edits, with chunks of every size."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import repair

ROWS = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain(rows):
    """The digest of one conversation's rows after damage: best first over (cost, audit)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        real = re.sub(r"[\x20\x09-\x0D]+", "", text)
        cut = not real or real[-1] not in ".!?"
        fault = "blank" if not real else "duplicate" if (role, text) in seen else "truncated" if cut else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            count[fault] += 1
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    first = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    heap, done = [(0, "", 0, "start", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("start", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        ask = "assistant" if state == "u" else "user"
        steps = [(3, "I", i, ask[0], f"{ask}:")]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((4, "D", i + 1, state, None))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                steps.append((3 + more, "R", i + 1, ask[0], f"{ask}:{text}"))
                if role[:1] == ask[0] or (role[:1] == "s" and state == "start"):
                    steps.append((more, "K", i + 1, role[0], f"{role}:{text}"))
        for c, e, j, s, line in steps:
            heapq.heappush(heap, (cost + c, audit + e, j, s, out if line is None else (*out, line)))
    return (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def run(spark, rows, chunk=repair.CHUNK, parts=3):
    frame = spark.createDataFrame(rows, ROWS).repartition(parts)
    found = repair.Repair(frame, chunk)
    out = repair.digest(frame, found).collect()
    assert len(out) == len({r[0] for r in rows})
    return {r["conv_id"]: tuple(r)[1:] for r in out}, found


def by_conv(rows):
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


def conversation(rng, conv, n, odd=0.2):
    rows = []
    for turn in range(n):
        role = "user" if turn % 2 == 0 else "assistant"
        if rng.random() < odd:
            role = rng.choice(["system", "user", "assistant", "tool", "", None, "sam"])
        text = f"text {rng.randint(0, n)}" + rng.choice([".", "!", "", " ? \n"])
        if rng.random() < odd / 2:
            text = rng.choice(["", " \t", None, "same."])
        rows.append((conv, None if rng.random() < 0.05 else turn + rng.randint(0, 1), role, text))
        rows += rows[-1:] * (rng.choice([0, 0, 0, 1, 3]) if rng.random() < odd else 0)
    return rows


@pytest.mark.parametrize("chunk", [1, 3, repair.CHUNK])
def test_equals_plain_search(spark, chunk):
    rng = random.Random(chunk)
    rows = [r for c in range(25) for r in conversation(rng, c, rng.randint(1, 12), rng.choice([0, 0.2, 0.7]))]
    got, _ = run(spark, rows, chunk)
    for conv, own in by_conv(rows).items():
        assert got[conv] == plain(own), own


def test_one_hot_conversation(spark):
    """Many chunks over all ranges, most of the rows in one conversation, and long runs of copies."""
    rng = random.Random(7)
    rows = conversation(rng, 1, 900, 0.1) + [(1, 2000, "user", "again and again.")] * 500 + conversation(rng, 2, 5)
    got, found = run(spark, rows, chunk=16)
    assert found.chunks.filter("ck = 'v1'").count() > 30
    assert 1 <= found.passes <= 6  # vectors meet after few rows
    for conv, own in by_conv(rows).items():
        assert got[conv] == plain(own)


def test_vectors_that_never_meet(spark):
    """Only rows that cannot be kept: chunk after chunk is fixed up, and the result stays exact."""
    rows = [(1, i, "tool", f"text {i}.") for i in range(41)]
    got, found = run(spark, rows, chunk=4)
    assert got[1] == plain(by_conv(rows)[1])


def test_hard_rows(spark):
    rows = [
        (None, None, None, None), (None, None, "user", "a."), (1, None, "system", "s."), (1, 5, "user", "u?"),
        (2, 0, "assistant", ""), (3, 0, "user", "x" * 200_000 + "."), (3, 2, "assistant", "y" * 200_000),
        (4, 1, "user", "a."), (4, 1, "user", "a."), (4, 1, "assistant", "b!"), (5, 0, "Ünicode", "z."), (6, 0, "system", "only."),
    ]
    got, _ = run(spark, rows)
    for conv, own in by_conv(rows).items():
        assert got[conv] == plain(own), own


def test_repaired_rows_are_legal(spark):
    rng = random.Random(11)
    rows = [r for c in range(10) for r in conversation(rng, c, 9, 0.5)]
    frame = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("q") for c in ("g", "pos", "edit", "first", "copies", "ck", "code")})
    found = repair.Repair(frame)
    out = found.repaired().orderBy("ck", "g", "pos", "part").collect()
    for conv in range(10):
        own = "".join(r["role"][0] for r in out if r["conv_id"] == conv)
        assert re.fullmatch("(s?(ua)+)?", own), own


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! x?") for c in range(20) for t in range(10)] + [(None, None, None, None)]
    got = sorted(map(tuple, repair.damage(spark.createDataFrame(rows, ROWS)).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(want, key=repr)


def test_empty_table_and_dropped_conversations(spark):
    none = spark.createDataFrame([], ROWS)
    assert repair.digest(none, repair.Repair(none)).count() == 0
    ids = spark.createDataFrame([(7, 0, "user", "a.")], ROWS)
    assert tuple(repair.digest(ids, repair.Repair(none)).first()) == (7, 0, 0, 0, 0, 0, 0, "", EMPTY)


def test_fix_up_equals_a_new_run():
    rng = np.random.default_rng(5)
    code, copies = rng.integers(0, 16, (200, 12)), rng.integers(1, 4, (200, 12))
    code[::3, :5] = -1
    old, new = (repair._opened(rng.integers(0, 9, (200, 4))) for _ in range(2))
    left = repair.backward(code, copies, old)
    assert (repair.fix_up(code, copies, old, new, left) == repair.backward(code, copies, new)).all()
