"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text. A text is
compressed with both, in blocks, so that its own history does not hide what the dictionaries know.
The difference of the two sizes over the text's size, its compressibility and its length go through
a logistic curve that is fitted on labelled texts the dictionaries have not seen.

Bound of the fit: the first ``SAMPLE`` labelled training rows in hash order, every second one for
the dictionaries (at most ``DICT_BYTES`` per class) and the others for the curve (at most
``CURVE_BYTES``). Scoring reads every text whole.

Cases: null and empty texts get the score of an empty text. Labels that are null are not used; a
document with several label rows counts with each. Without training rows of both classes the score
is the share of label 1 among them, and 1 without any. Repeated rows and null ids give one row each.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import plus

SAMPLE = 8000
DICT_BYTES = 6_000_000
CURVE_BYTES = 24_000_000
DICT_SIZE = 65_536
BLOCK = 2048
LEVEL = 3
GOOD = 0.7


@dataclass
class Model:
    """Dictionaries for label 0 and 1 and the curve's weights; without them a constant score."""

    dictionaries: tuple[bytes, bytes] | None
    weights: list[float]
    constant: float = 1.0


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def _dictionary(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_SIZE, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b"".join(samples)[-DICT_SIZE:].ljust(8, b" ")


class Sizer:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        import zstandard

        self.compressors = []
        for data in dictionaries:
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
            own = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            self.compressors.append(own.compress)

    def __call__(self, text: str | None) -> tuple[int, int, int]:
        data = (text or "").encode()
        parts = blocks(data)
        bad, good = (sum(len(c(p)) for p in parts) for c in self.compressors)
        return bad, good, len(data)


def features(sizes: np.ndarray) -> np.ndarray:
    """Columns for the curve from rows (size under bad, size under good, bytes)."""
    bad, good, n = sizes.astype(float).T
    n = np.maximum(n, 1)
    gain = 10 * (bad - good) / n
    ratio = 5 * np.minimum(bad, good) / n
    length = (np.log(np.maximum(n, 16)) - 7) / 2  # below 16 bytes the curve would only be drawn out
    one = np.ones_like(n)
    return np.stack([one, gain, ratio, length, gain * length, ratio * length, gain**2, ratio**2, length**2], axis=1)


def curve(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps, each halved until the loss falls."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + ridge / 2 * w @ w)

    weights = np.zeros(x.shape[1])
    now = loss(weights)
    for _ in range(rounds):
        p = curve(x, weights)
        slope = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(slope, x.T @ (y - p) - ridge * weights)
        size = 1.0
        while size > 1e-6 and loss(weights + size * step) > now:
            size /= 2
        if size <= 1e-6:
            break
        weights = weights + size * step
        now, before = loss(weights), now
        if before - now < 1e-9 * max(before, 1):
            break
    return weights


def fit_rows(rows: Iterator[tuple[str | None, int]]) -> Model:
    """Fit on (text, label) in the sample's order."""
    samples: tuple[list[bytes], list[bytes]] = ([], [])
    used, held, spent, labels = [0, 0], [], 0, []
    for n, (text, label) in enumerate(rows):
        data = (text or "").encode()
        labels.append(label)
        if n % 2 == 0 and used[label] < DICT_BYTES:
            samples[label].extend(blocks(data))
            used[label] += len(data)
        elif n % 2 and spent < CURVE_BYTES:
            held.append((text, label))
            spent += len(data)
    if not all(used) or len({x[1] for x in held}) < 2:
        return Model(None, [], float(np.mean(labels)) if labels else 1.0)
    dictionaries = (_dictionary(samples[0]), _dictionary(samples[1]))
    size = Sizer(dictionaries)
    x = features(np.array([size(t) for t, _ in held]))
    return Model(dictionaries, fit_curve(x, np.array([y for _, y in held], float)).tolist())


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, remainder 2 of 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the labelled rows that are not held out; see the module's bounds."""
    order = F.xxhash64(F.lit("quality"), "id")
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out("id"))
        .withColumn("ord", order)
        .orderBy("ord", "label")
        .limit(SAMPLE)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most SAMPLE ids travel to all tasks, and at most their texts to the one that fits.
    sample = texts.join(F.broadcast(chosen), "id").orderBy("ord", "label", "text").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_rows(rows()))], pa.binary())], ["model"])

    row = sample.select("text", "label").coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row["model"]) if row else fit_rows(iter(()))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(id, score) of every row; with ``keep`` all columns and ``score``, which replaces one of that name."""
    rows = docs.drop("score") if keep else docs.select(id_col, text_col)
    out = plus((rows if keep else rows.drop(text_col)).schema, score="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(model.dictionaries) if model.dictionaries else None
        weights = np.array(model.weights)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            if size and batch.num_rows:
                sizes = np.array([size(t.as_py()) for t in batch.column(at)])
                scores = curve(features(sizes), weights)
            else:
                scores = np.full(batch.num_rows, model.constant)
            kept = [n for n in range(batch.num_columns) if keep or n != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(scores, pa.float64())],
                [*(batch.schema.names[n] for n in kept), "score"],
            )

    return rows.mapInArrow(run, out)


def digest(scored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return scored.select(
        id_col,
        is_held_out(id_col).alias("held_out"),
        "score",
        F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"),
    )
