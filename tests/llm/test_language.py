"""Language identification: codes, a plain recount of the model, and hard rows."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import language
from vellum.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"
WORDS = {"en": "the and of with there thing", "fr": "été une avec où leçon près", "de": "über das nicht straße wäre und", "es": "año señor está qué niño con"}


def texts(n, seed=1):
    rng = random.Random(seed)
    for i in range(n):
        lang = sorted(WORDS)[i % 4]
        yield i, " ".join(rng.choices(WORDS[lang].split(), k=rng.randint(3, 12))), lang


def grams(text):
    """Slots of a text, gram by gram."""
    data = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in text.lower().encode())
    data = b" " + data + b" "
    for i in range(1, len(data) - 1):
        if data[i] != 32:
            key = data[i - 1] << 16 | data[i] << 8 | data[i + 1]
            yield (key * 2654435761 & 0xFFFFFFFF) >> 18


def shares(text):
    count = defaultdict(int)
    for g in grams(text or ""):
        count[g] += 1
    total = sum(count.values())
    return {g: n / total for g, n in count.items()}


def plain_model(rows):
    """The classifiers by the formulas, with dicts: (languages, code, weight by bit and slot, slope, shift, trust)."""
    rows = [(shares(t), lang) for t, lang in rows if lang is not None and any(c.isalpha() for c in t or "")]
    langs = sorted({lang for _, lang in rows})
    code = language.codewords(len(langs))
    total = {lang: defaultdict(float) for lang in langs}
    count = defaultdict(int)
    for share, lang in rows:
        count[lang] += 1
        for g, x in share.items():
            total[lang][g] += x
    p = lambda lang, g: (total[lang][g] + 1 / language.SLOTS) / (count[lang] + 1)
    out = []
    for b in range(code.shape[1]):
        one = [x for i, x in enumerate(langs) if code[i, b] > 0]
        other = [x for x in langs if x not in one]
        weight = lambda g, one=one, other=other: math.log(sum(p(x, g) for x in one) / len(one)) - math.log(sum(p(x, g) for x in other) / len(other))
        margin = {x: [] for x in langs}
        for share, lang in rows:
            margin[lang].append(sum(x * weight(g) for g, x in share.items()))
        mean = {x: np.mean(m) for x, m in margin.items()}
        var = {x: np.var(m) for x, m in margin.items()}
        wrong = {x: (sum(m * (1 if x in one else -1) <= 0 for m in margin[x]) + 0.5) / (len(margin[x]) + 1) for x in langs}
        side = lambda d, s: sum(d[x] for x in s) / len(s)
        gap = max(side(mean, one) - side(mean, other), 0)
        spread = (side(var, one) + side(var, other)) / 2 + 1e-3
        slope = gap / (spread + (gap / language.FLAT) ** 2)
        out.append((weight, slope, -slope * (side(mean, one) + side(mean, other)) / 2, max(0, 1 - side(wrong, one) - side(wrong, other))))
    return langs, code, out


def plain_predict(text, model):
    langs, code, bits = model
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    share, loss = shares(text), [0.0] * len(langs)
    for b, (weight, slope, shift, trust) in enumerate(bits):
        z = slope * sum(x * weight(g) for g, x in share.items()) + shift
        for i in range(len(langs)):
            loss[i] += trust * np.logaddexp(0, -z * code[i, b])
    part = [math.exp(min(loss) - x) for x in loss]
    return langs[int(np.argmin(loss))], 1 / sum(part)


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20, 60])
def test_codewords_are_far_apart(n):
    code = language.codewords(n)
    assert set(np.unique(code)) == {-1, 1} and len(code) == n
    assert all(len(set(c)) == 2 for c in code.T)
    distance = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
    assert min(distance) >= max(1, code.shape[1] // 4)


def test_predictions_equal_a_plain_model(spark):
    rows = list(texts(80)) + [(100, "the thing été", None), (101, None, "en"), (102, "12 :; —", "fr"), (103, "zzz 한국어", None), (104, "the et", None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = plain_model([(t, lang) for _, t, lang in rows])
    got = {r["doc_id"]: r for r in language.predict(docs, language.fit(docs)).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        lang, score = plain_predict(text, model)
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score, abs=1e-3), text


def test_texts_in_two_languages_are_flagged(spark):
    docs = spark.createDataFrame(list(texts(200)), SCHEMA)
    model = language.fit(docs)
    both = " ".join(["the and of with there thing été une avec où leçon près"] * 3)
    asked = spark.createDataFrame([(1, both), (2, "the and of with there thing " * 9)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.predict(asked, model).collect()}
    assert got[1]["score"] < got[2]["score"] and not got[2]["ambiguous"] and got[2]["lang_pred"] == "en"


def test_hard_rows_and_clashing_names(spark):
    rows = [(None, "the thing", "en"), (1, None, None), (2, "", "fr"), (3, "123 !", "de"), (4, "x" * 300_000, None), (5, "ÉTÉ", None), (5, "ÉTÉ", None), *((50 + i, t, x) for i, t, x in texts(40))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("q") for c in ("score", "lang_pred", "_text", "slot", "v", "bit")})
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    seen = {r["doc_id"]: r for r in got}
    assert [seen[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and seen[1]["score"] == 0
    assert seen[4]["lang_pred"] in WORDS and seen[5]["lang_pred"] == "fr" and seen[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("langs, want", [((), "und"), (("xx",), "xx")])
def test_no_language_and_one(spark, langs, want):
    rows = [(i, "some text", lang) for i, lang in enumerate(langs)] + [(9, "more text", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = language.predict(docs, language.fit(docs)).filter("doc_id = 9").first()
    assert got["lang_pred"] == want and got["score"] == len(langs)
    assert language.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_held_out_accuracy_and_repeatability(spark):
    found = QUERIES["op11_language"](spark, SMALL)
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows) > 0
    again = QUERIES["op11_language"](spark, SMALL)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
