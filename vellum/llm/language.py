"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary n-gram classifier tells the languages
whose bit is 1 from the others: its weight for an n-gram is the logarithm of the n-gram's mean
frequency on the one side over that on the other. A second pass over the training texts measures each
classifier's margins, which gives its curve (two normal distributions, each at least a ``FLAT``-th of the gap
between them wide, so that a text in two languages lies between) and its weight in decoding, one
minus twice its error. A text's language is the codeword with the least weighted logistic loss over all
bits; the score is the share of ``exp(-loss)`` among all languages. ``ambiguous`` is set where the next
language's share is over a third of the best one's.

Up to six languages the code holds every split of the languages; with more, ``12 * log2(languages)``
columns drawn by a fixed rule, the draw with the largest least distance.

N-grams are three bytes of the lower-cased text; ASCII bytes that are no letters count as blanks, and the
text has a blank before and after. They are hashed to ``SLOTS`` slots. Frequencies are summed over all
training texts in whole units of 2**-40 of a text, so that the model is the same however the rows are
dealt. What a task and the driver hold grows with the number of languages, not with the rows.

Cases: null texts and texts without a letter get ``und`` with score 0 and are not learned from. Rows with
null ids are training rows. Null languages are not learned. With one language every text gets it with
score 1; with none all get ``und`` with score 0. Repeated rows give one row each and count each.
Equal losses go to the first language by name. Other columns are not read, and none of the names used here
can clash with them. Very long texts are read whole, in chunks of their own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import plus
from vellum.llm.quality import is_held_out
from vellum.llm.words import text_bytes

SLOTS = 16_384
UNIT = float(2**40)
ROWS_AT_ONCE, BYTES_AT_ONCE = 128, 4_000_000
ALL_SPLITS = 6
AMBIGUOUS = 1 / 3
FLAT = 3
NONE = "und"
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Model:
    """Languages by name, code (language, bit) of +1 and -1, weights (slot, bit), curves and bit weights."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    shift: np.ndarray
    trust: np.ndarray


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language; no column is constant and none repeats another or its inverse."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= ALL_SPLITS:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, np.int8).T
    bits = int(np.ceil(12 * np.log2(n)))
    best, least = None, -1
    for seed in range(20):
        code = np.random.default_rng(seed).choice(np.array([1, -1], np.int8), (n, bits))
        code[0] = 1  # a column and its inverse ask the same
        code = np.unique(code[:, (code == -1).any(axis=0)], axis=1)
        wide = code.astype(np.int32)
        agree = wide @ wide.T
        np.fill_diagonal(agree, -code.shape[1])
        distance = int((code.shape[1] - agree.max()) // 2)
        if distance > least:
            best, least = code, distance
    return best


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows that are counted at once: a few rows, or few bytes."""
    _, at = text_bytes(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(at, at[first] + BYTES_AT_ONCE, "right")) - 1
        last = min(max(last, first + 1), first + ROWS_AT_ONCE, len(texts))
        yield first, last
        first = last


def gram_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(counts by row and slot, whether the row has a letter)."""
    texts = pc.fill_null(texts, "")
    data, at = text_bytes(pc.utf8_lower(texts))
    n = len(at) - 1
    # A blank byte follows every row, and one stands in front of all.
    row = np.repeat(np.arange(n), np.diff(at))
    padded = np.full(len(data) + n + 1, 32, np.uint8)
    padded[np.arange(len(data)) + row + 1] = np.where(_LETTER[data], data, 32)
    ends = at[1:] + np.arange(n) + 1
    letter = _LETTER[padded]
    wide = padded.astype(np.uint32)
    key = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:] if len(wide) > 2 else wide[:0]
    keep = letter[1:-1][: len(key)]
    slot = ((key * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)[keep]
    owner = np.searchsorted(ends, np.flatnonzero(keep) + 1)
    counts = np.bincount(owner * SLOTS + slot, minlength=n * SLOTS).reshape(n, SLOTS)
    has = counts.any(axis=1)
    ascii_only = np.zeros(n, bool)
    low = (padded >= 97) & (padded <= 122)
    ascii_only[np.searchsorted(ends, np.flatnonzero(low))] = True
    for r in np.flatnonzero(has & ~ascii_only):
        has[r] = any(c.isalpha() for c in texts[int(r)].as_py())
    return counts, has


def _frequencies(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, n-gram shares of the rows, which rows have a letter)."""
    for first, last in _pieces(pc.fill_null(texts, "")):
        counts, has = gram_counts(texts.slice(first, last - first))
        yield first, counts / np.maximum(counts.sum(axis=1, keepdims=True), 1), has


def _table(columns: list, types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _learn_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for first, share, has in _frequencies(batch.column(0)):
            units = np.rint(share * UNIT).astype(np.int64)
            own = langs[first : first + len(has)]
            for lang in sorted(set(own[has])):
                total = sums.setdefault(lang, np.zeros(SLOTS + 1, np.int64))
                mine = has & (own == lang)
                total[:SLOTS] += units[mine].sum(axis=0)
                total[SLOTS] += int(mine.sum())
    for lang, total in sums.items():
        slot = np.flatnonzero(total)
        yield _table([[lang] * len(slot), slot, total[slot]], [pa.string(), pa.int32(), pa.int64()], ["lang", "slot", "v"])


def bit_weights(sums: np.ndarray, rows: np.ndarray, code: np.ndarray) -> np.ndarray:
    """(slot, bit) weights from (language, slot) frequency sums and rows per language."""
    share = (sums + 1 / SLOTS) / (rows[:, None] + 1)
    weights = np.empty((SLOTS, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        one, other = share[code[:, b] > 0].mean(axis=0), share[code[:, b] < 0].mean(axis=0)
        weights[:, b] = np.log(one) - np.log(other)
    return weights


def curves(moments: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slope, shift, trust) per bit from (language, bit) rows of count, sum, sum of squares, wrong sides."""
    n, total, square, wrong = np.moveaxis(moments, 2, 0)
    n = np.maximum(n, 1)
    mean = total / n
    spread = np.maximum(square / n - mean**2, 0)
    error = (wrong + 0.5) / (n + 1)
    one, other = code > 0, code < 0

    def side(x: np.ndarray, which: np.ndarray) -> np.ndarray:
        return (x * which).sum(axis=0) / which.sum(axis=0)

    high, low = side(mean, one), side(mean, other)
    var = (side(spread, one) + side(spread, other)) / 2 + 1e-3
    gap = np.maximum(high - low, 0)
    slope = gap / (var + (gap / FLAT) ** 2)
    trust = np.clip(1 - side(error, one) - side(error, other), 0, 1)
    return slope, -slope * (high + low) / 2, trust


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows of ``docs`` with a language; the caller leaves the held-out rows away."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null")
    sums = rows.mapInArrow(_learn_sums, "lang string, slot int, v long").groupBy("lang", "slot").agg(F.sum("v").alias("v")).toArrow()
    languages = sorted(set(sums.column("lang").to_pylist()))
    code = codewords(len(languages))
    if len(languages) < 2:
        none = np.zeros(0)
        return Model(languages, code, np.zeros((SLOTS, 0), np.float32), none, none, none)
    found = np.zeros((len(languages), SLOTS + 1))
    which = {lang: i for i, lang in enumerate(languages)}
    at = np.array([which[x] for x in sums.column("lang").to_pylist()])
    found[at, sums.column("slot").to_numpy()] = sums.column("v").to_numpy()
    weights = bit_weights(found[:, :SLOTS] / UNIT, found[:, SLOTS], code)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((*code.shape, 4))
        for batch in batches:
            own = np.array([which.get(x, -1) for x in batch.column(1).to_pylist()], int)
            for first, share, has in _frequencies(batch.column(0)):
                lang = own[first : first + len(has)]
                use = has & (lang >= 0)
                margin = (share[use].astype(np.float32) @ weights).astype(float)
                sign = code[lang[use]]
                for k, x in enumerate((np.ones_like(margin), margin, margin**2, margin * sign <= 0)):
                    np.add.at(moments[:, :, k], lang[use], x)
        lang, bit = (x.ravel() for x in np.indices(code.shape))
        names, columns = ["lang", "bit", "m0", "m1", "m2", "m3"], [lang, bit, *moments.reshape(-1, 4).T]
        yield _table(columns, [pa.int32()] * 2 + [pa.float64()] * 4, names)

    parts = rows.mapInArrow(measure, "lang int, bit int, m0 double, m1 double, m2 double, m3 double")
    total = parts.groupBy("lang", "bit").agg(*[F.sum(f"m{k}").alias(f"m{k}") for k in range(4)]).toArrow()
    moments = np.zeros((*code.shape, 4))
    place = (total.column("lang").to_numpy(), total.column("bit").to_numpy())
    for k in range(4):
        moments[(*place, k)] = total.column(f"m{k}").to_numpy()
    return Model(languages, code, weights, *curves(moments, code))


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number, score, ambiguous) of rows of classifier margins."""
    z = margins * model.slope + model.shift
    right, wrong = np.logaddexp(0, -z) * model.trust, np.logaddexp(0, z) * model.trust
    loss = right @ (model.code.T > 0) + wrong @ (model.code.T < 0)
    loss = np.round(loss, 6)
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    best = loss.argmin(axis=1)
    second = np.sort(share, axis=1)[:, -2]
    return best, np.round(1 / share.sum(axis=1), 6), second > AMBIGUOUS


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` and ``ambiguous`` of every row."""
    rows = docs.select(F.col(text_col).alias("_text"), *keep)
    out = plus(rows.drop("_text").schema, lang_pred="string", score="double", ambiguous="boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, NONE], object)
        for batch in batches:
            n = batch.num_rows
            lang, score, unsure = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n, bool)
            for first, share, has in _frequencies(batch.column(0)) if model.languages else ():
                use = np.flatnonzero(has) + first
                if len(model.languages) == 1:
                    lang[use], score[use] = 0, 1.0
                elif len(use):
                    margin = (share[has].astype(np.float32) @ model.weights).astype(float)
                    lang[use], score[use], unsure[use] = decode(margin, model)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names[lang], pa.string()), pa.array(score), pa.array(unsure)],
                schema=pa.schema([*list(batch.schema)[1:], ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())]),
            )

    return rows.mapInArrow(run, out)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fit on the rows that are not held out and predict every row."""
    model = fit(docs.filter(~is_held_out(id_col)), text_col, lang_col)
    found = predict(docs, model, text_col, (id_col,))
    return found.select(id_col, is_held_out(id_col).alias("held_out"), "lang_pred", "score", "ambiguous")
