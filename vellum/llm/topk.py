"""Exact top-k search by inner product through a pivot-distance index.

Vectors become whole numbers, floor(1024 * x). With M the largest norm, a vector x gets one more
component sqrt(M^2 - |x|^2) and a query a zero: the largest inner products are then the smallest
distances, so the triangle inequality holds. Every vector is keyed by its nearest pivot and its
distance to it; rings of distances around a pivot are the annuli. A query first reads its nearest
annuli until they hold enough vectors; the k-th score found there is a radius, and the annuli
whose bound lies beyond that radius are never read. Bounds only skip annuli; scores are exact.

Bounds: ``SAMPLE`` vectors (first in hash order) place pivots and ring edges; every vector is
indexed. The driver holds pivots and one row per annulus (``PIVOTS`` * ``RINGS``). Annuli are read in
pieces of about ``PIECE`` vectors by blocks of about ``BLOCK`` queries.

Cases: vectors that are null or hold a null, NaN or infinite component take no part, as query or
candidate. Shorter vectors count as filled up with zeros; empty ones score 0. Repeated rows are
candidates as often as they occur; a query that is repeated with the same vector is answered once. A
query's own id is never its candidate. Null ids take no part; ids that are not whole numbers raise. Scores outside 64 bits stop at its
ends. Empty inputs give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import plus, staged

PIVOTS, RINGS, SAMPLE = 32, 8, 4096
PIECE, BLOCK = 8192, 1024
EXACT = 2.0**53


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    return vector.isNotNull() & finite


def matrix(lists: pa.Array) -> np.ndarray:
    """A list column as rows of equal length, filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    width = max(a.shape[1], b.shape[1])
    a, b = _wide(a, width), _wide(b, width)
    if not width or not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    af, bf = a.astype(float), b.astype(float)
    if np.abs(af).max() * np.abs(bf).max() * width < EXACT:
        return (af @ bf.T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


@dataclass
class Index:
    """Pivots, ring edges and the annuli's bounds and sizes."""

    norm2: float
    pivots: np.ndarray  # with the added component as last column
    edges: np.ndarray  # per pivot, inner ring edges
    low: np.ndarray | None = None  # per annulus
    high: np.ndarray | None = None
    count: np.ndarray | None = None

    def distances(self, v: np.ndarray, query: bool) -> np.ndarray:
        v = v.astype(float)
        width = max(v.shape[1], self.pivots.shape[1] - 1)
        v, p = _wide(v, width), _wide(self.pivots[:, :-1], width)
        own = (v * v).sum(1)
        dot = v @ p.T
        if query:
            total = own[:, None] + self.norm2
        else:
            dot = dot + np.sqrt(np.maximum(self.norm2 - own, 0))[:, None] * self.pivots[:, -1]
            total = 2 * self.norm2
        return np.sqrt(np.maximum(total - 2 * dot, 0))

    def bounds(self, v: np.ndarray) -> np.ndarray:
        """Per query and annulus: no vector of the annulus is closer than this."""
        d = np.repeat(self.distances(v, True), RINGS, axis=1)
        bound = np.maximum(np.maximum(d - self.high, self.low - d), 0)
        return np.where(self.count > 0, bound, np.inf)


def _place_pivots(v: np.ndarray, norm2: float) -> Index:
    """Farthest-first pivots of the sample, and edges that cut each pivot's sample evenly."""
    extra = np.sqrt(np.maximum(norm2 - (v.astype(float) ** 2).sum(1), 0))
    points = np.c_[v.astype(float), extra]
    chosen, away = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(PIVOTS, len(points)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
    index = Index(norm2, points[chosen], np.zeros((len(chosen), RINGS - 1)))
    d = index.distances(v, False)
    near = d.argmin(1)
    for p in range(len(chosen)):
        own = d[near == p, p]
        index.edges[p] = np.quantile(own, np.arange(1, RINGS) / RINGS) if len(own) else 0
    return index


def build(vectors: DataFrame) -> tuple[Index, DataFrame] | None:
    """The index and its rows (id, v, copies, cell, piece) from (id, v); None without vectors."""
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    norm2 = vectors.agg(F.max(norm)).first()[0]
    if norm2 is None:
        return None
    sample = vectors.select("v").orderBy(F.xxhash64("id", "v"), "v").limit(SAMPLE).toArrow()
    index = _place_pivots(matrix(sample.column("v")), norm2)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = index.distances(matrix(batch.column("v")), False)
            near = d.argmin(1)
            own = d[np.arange(len(d)), near]
            ring = (own[:, None] > index.edges[near]).sum(1)
            cell = pa.array((near * RINGS + ring).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell, pa.array(own)], [*batch.schema.names, "cell", "dist"])

    once = vectors.groupBy("id", "v").agg(F.count("*").alias("copies"))
    placed = staged(once.mapInArrow(place, plus(once.schema, cell="int", dist="double")))
    n = len(index.pivots) * RINGS
    index.low, index.high, index.count = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for r in placed.groupBy("cell").agg(F.min("dist"), F.max("dist"), F.count("*")).collect():
        index.low[r[0]], index.high[r[0]], index.count[r[0]] = r[1:]
    pieces = F.array(*(F.lit(int(-(-c // PIECE)) or 1) for c in index.count))
    piece = F.pmod(F.xxhash64("id", "v"), F.get(pieces, F.col("cell"))).cast("int")
    return index, placed.select("id", "v", "copies", "cell", piece.alias("piece"))


def _requests(index: Index, queries: DataFrame, k: int, blocks: int) -> DataFrame:
    """(query, qid, qv, floor, cell, piece, block): what each query still has to read.

    Without a floor these are its nearest annuli that hold more than k vectors together; with one,
    all others within the radius that the floor stands for.
    """
    pieces = np.maximum(-(-index.count // PIECE), 1)
    pivots = len(index.pivots)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("qv"))
            bounds = index.bounds(v)
            order = np.argsort(bounds, axis=1, kind="stable")
            held = np.cumsum(np.where(np.isfinite(np.take_along_axis(bounds, order, 1)), index.count[order], 0), axis=1)
            first = np.zeros(bounds.shape, bool)
            np.put_along_axis(first, order, np.c_[np.zeros(len(v)), held[:, :-1]] <= k, axis=1)
            first &= np.isfinite(bounds)
            asked = first
            if "floor" in batch.schema.names:
                floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(float)
                radius2 = (v.astype(float) ** 2).sum(1) + index.norm2 - 2 * floor
                # No floor: fewer than k were found. The slack covers rounding of the distances.
                radius = np.where(np.isnan(floor), np.inf, np.sqrt(np.maximum(radius2, 0)))
                radius = radius * (1 + 1e-9) + 1e-5 * np.sqrt(index.norm2) + 1e-6
                asked = np.isfinite(bounds) & ~first & (bounds <= radius[:, None])
            near = index.distances(v, True).argmin(1)
            row, cell = np.nonzero(asked)
            times = pieces[cell]
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            spread = batch.column("query").to_numpy(zero_copy_only=False).astype(np.int64)
            if blocks <= pivots:
                block = near * blocks // pivots
            else:
                each = -(-blocks // pivots)
                block = near * each + spread % each
            taken = batch.take(pa.array(row))
            extra = [pa.array(cell.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(block[row].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*taken.columns, *extra], [*taken.schema.names, "cell", "piece", "block"])

    schema = plus(queries.schema, cell="int", piece="int", block="long")
    return queries.mapInArrow(ask, schema)


FOUND = "query bigint, qid bigint, id bigint, score bigint, copies bigint"


def _read(rows: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    """The k best of each asked (query, piece)."""
    key = ["cell", "piece", "block"]
    requests = staged(requests)
    needed = requests.select(*(F.col(c).alias(c) for c in key)).distinct()  # columns of their own
    own = rows.join(needed, ["cell", "piece"])

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if left.num_rows and right.num_rows:
            ids, copies = left.column("id").to_numpy(), left.column("copies").to_numpy()
            q, qid = right.column("query").to_numpy(), right.column("qid").to_numpy()
            floor = right.column("floor").to_numpy() if "floor" in right.column_names else np.full(len(q), np.nan)
            scores = products(matrix(right.column("qv")), matrix(left.column("v")))
            least = np.where(np.isnan(floor.astype(float)), -(2**63), np.nan_to_num(floor.astype(float))).astype(np.int64)
            keep = (scores >= least[:, None]) & (ids[None, :] != qid[:, None])
            for n in range(len(q)):
                at = np.flatnonzero(keep[n])
                if len(at) > k:
                    top = scores[n, at]
                    at = at[top >= np.partition(top, len(top) - k)[len(top) - k]]
                at = at[np.lexsort((ids[at], ~scores[n, at]))][:k]  # ~x falls as x rises, without overflow
                out.append(np.stack([np.full(len(at), q[n]), np.full(len(at), qid[n]), ids[at], scores[n, at], copies[at]]))
        table = np.concatenate(out, axis=1) if out else np.zeros((5, 0), np.int64)
        return pa.table(list(map(pa.array, table.astype(np.int64))), names=["query", "qid", "id", "score", "copies"])

    return own.groupBy(*key).cogroup(requests.groupBy(*key)).applyInArrow(best, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all rows but its own."""
    spark = vectors.sparkSession

    def plain(df: DataFrame) -> DataFrame:
        kept = df.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
        return kept.select(F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector_col)).alias("v"))

    out = "query_id bigint, rank int, vec_id bigint, score bigint"
    rows = staged(plain(vectors))
    built = build(rows)
    asked = staged(plain(queries).distinct().select(F.xxhash64("id", "v").alias("query"), F.col("id").alias("qid"), F.col("v").alias("qv")))
    total = asked.count()
    if built is None or not total:
        return spark.createDataFrame([], out)
    index, placed = built
    blocks = -(-total // BLOCK)
    near = staged(_best(_read(placed, _requests(index, asked, k, blocks), k), k))
    # k candidates are enough for a floor whatever their copies: copies only raise it.
    floor = near.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    rest = _read(placed, _requests(index, asked.join(floor, "query", "left"), k, blocks), k)
    found = _best(near.drop("rank").unionByName(rest), k)
    copies = found.select("query", "qid", "id", "score", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return _best(copies, k).select(
        F.col("qid").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )
