"""Ranked search against a plain scorer; bounds of blocks; hard rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import ranked

TEXTS = "doc_id long, text string"
ITEMS = "item_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(ranked.WORD, (text or "").translate(LOWER))


def plain(docs, items, k=ranked.K):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    own = {}
    for item, text in items:
        own.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in own.items():
        found = []
        for i, c in counts:
            m = 100 - 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items, **more):
    docs, items = (spark.createDataFrame(x, s).repartition(3) for x, s in ((docs, TEXTS), (items, ITEMS)))
    return sorted((tuple(r) for r in ranked.search(docs, items, **more).collect()), key=repr)


def corpus(n, seed=3):
    """Topics with their own words, frequent words, and copies."""
    rng = random.Random(seed)
    frequent = [f"w{i}" for i in range(20)]
    rows = []
    for i in range(n):
        topic = [f"t{i % 7}x{j}" for j in range(30)]
        rows.append((i, " ".join(rng.choices(frequent, k=rng.randint(1, 40)) + rng.choices(topic, k=rng.randint(0, 30)))))
    return rows + [(n + i, rows[5][1]) for i in range(60)]


@pytest.mark.parametrize("cell", [2048, 50])
def test_equals_plain_scores(spark, monkeypatch, cell):
    monkeypatch.setattr(ranked, "CELL", cell)
    docs = corpus(400)
    items = [(1, "W1 w2 t3x1 t3x2 t3x4"), (2, docs[5][1]), (3, "w0"), (4, "none here"), (5, "t1x1 t2x2, t4x9!w3")]
    assert got(spark, docs, items) == plain(docs, items)


def test_hard_rows(spark):
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, "... !"), (4, "alpha " * 50_000 + "é日本 beta"), (5, "Alpha É"), (6, "gamma"), (6, "gamma"), (6, "alpha gamma")]
    items = [(None, "alpha"), (1, "É alpha"), (1, "gamma"), (2, None), (3, "é日本"), (4, "beta beta"), (5, "...")]
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, items, k=1) == plain(docs, items, 1)


def test_empty_tables_and_clashing_names(spark):
    assert got(spark, [], [(1, "a")]) == got(spark, [(1, "a")], []) == got(spark, [(1, "a")], [(1, None)]) == []
    docs = spark.createDataFrame(corpus(60), TEXTS).withColumns({c: F.lit("q") for c in ("id", "n", "score", "rank", "ids", "item", "term")})
    items = spark.createDataFrame([(1, "w1 w2")], ITEMS).withColumns({c: F.lit("q") for c in ("term", "item", "score", "n")})
    assert sorted((tuple(r) for r in ranked.search(docs, items).collect()), key=repr) == plain(corpus(60), [(1, "w1 w2")])


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("é", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "y x")], "item_id string, text string")
    assert [(r["rank"], r["doc_id"]) for r in ranked.search(docs, items).orderBy("rank").collect()] == [(1, None), (2, "a"), (3, "b")]


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "TERMS", 6)
    docs, items = corpus(120), [(i, f"w{i} t{i % 7}x1 t{i % 7}x2 w3") for i in range(6)]
    assert got(spark, docs, items) == plain(docs, items)


def test_bounds_hold_and_skip():
    """No document scores above its block's bound, and a floor keeps blocks closed."""
    docs, item = corpus(600), words("t3x1 t3x2 t3x5 t3x7 w1 w2")
    terms = sorted(set(item))
    vocab = ranked.Vocabulary([t.encode() for t in terms], [1], [np.arange(len(terms))])
    held = [(c, sum(c.values())) for c in (Counter(words(t)) for _, t in docs)]
    vectors = [[(k, c[t]) for k, t in enumerate(terms) if t in c] for c, _ in held]
    start = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    flat = [x for v in vectors for x in v]
    term, tf = np.array([x[0] for x in flat]), np.array([x[1] for x in flat])
    stats = ranked.Statistics(len(docs), sum(n for _, n in held), np.full(len(terms), 1000))
    x = ranked.saturated(tf, np.repeat([n for _, n in held], np.diff(start)), stats)
    weights = np.array([3000 if t.startswith("t") else 100 for t in terms])
    cell = ranked.build_cell(start, term, x, vocab, weights, np.zeros(1, np.int64))
    scores = np.zeros(len(docs), np.int64)
    np.add.at(scores, np.repeat(np.arange(len(docs)), np.diff(start)), weights[term] * x)
    own = ranked.Searcher(cell, weights)
    block, bound = own.bounds(vocab.item_terms[0], 0)
    assert len(block) == len(cell.block_start) - 1
    for b, most in zip(block, bound):
        members = cell.block_docs[cell.block_start[b] : cell.block_start[b + 1]]
        assert scores[members].max() <= most
    floor = int(np.sort(scores)[-20])
    own = ranked.Searcher(ranked.build_cell(start, term, x, vocab, weights, np.array([floor])), weights)
    assert len(own.c.block_start) < len(cell.block_start)
    docs_found, found = own.best(vocab.item_terms[0], floor, 20)
    assert sorted(docs_found) == np.flatnonzero(scores >= floor).tolist() and (found == scores[docs_found]).all()
    assert own.scored < 0.5 * np.count_nonzero(scores)
