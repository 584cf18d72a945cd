"""Exact n-gram Jaccard join: classes of documents whose shingle sets are linked.

Distance 1 - Jaccard is a metric, so pivots and the triangle inequality bound who can link to whom.

1. Sets. Documents with one set become one node (a 64-bit hash of the set).
2. Singleton pivots. All shingles stand in one fixed order, frequent ones last; a set belongs to the
   region of its first shingle, and as boundary set to the regions of its next ones, as far as a
   linked set may start there (n - ceil(0.75 n) + 1 shingles) and ``EXTRA`` more. Two linked sets meet
   in a region, both no later in their order than they may differ, and then in ``EXTRA`` more regions.
   Regions of at most ``SMALL`` nodes give the pairs that stand so early in both; those that meet
   often enough are candidates. The candidates' connected parts are families.
3. Singleton pivots again. Nodes of larger regions, nodes whose first shingles reach the frequent
   ones, and families of more than ``REGION`` nodes go through the same regions once more, their
   shingles ordered by how many of these nodes hold them, counted. Those that no other holds come
   first, so a node meets only what shares its rarest shingles. A region that is still large is one
   family from each size to the next that may be linked.
4. Document pivots. Of the families of step 3, those of more than ``REGION`` nodes are cut into
   Voronoi regions of document pivots: a node goes to its nearest pivot's region, and as boundary
   node to each earlier pivot within twice the radius of that, if what is there is not in its class by
   the pivots already. Regions that are still too large are cut again; one that pivots do not cut is
   joined in blocks.
5. In a family or region, one pivot at a time: its ball is linked, and a member of the ball is only
   compared with outer nodes that the triangle inequality leaves.
6. Links of families and regions form the classes.

Frequent shingles are learnt from a sample of the texts, at most ``FREQUENT`` of them; they only
change the order and thus the cost, never the result. All sets are whole sets of whole texts.

Cases: null and empty texts have no set and are linked with nothing; so are rows with a null id,
whose class is null. Repeated rows are in one class. An id with several texts has one row for each,
and a class for each set. Ids must be whole numbers, or texts of such; others raise. An empty table has no classes.
Shingles and sets are told apart by 64-bit hashes, so the join is exact up to their collisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import staged
from vellum.llm.graph import components
from vellum.llm.words import chunks, mix, shingle_hashes, word_hashes

SIZE = 5
#: 100 * intersection >= 75 * union; RADIUS is the distance that stands for.
RADIUS = 0.25
#: Shingles that a set sends beyond those a linked set must meet: so many more a pair has to share.
EXTRA = 3
SMALL = 64
REGION = 2000
PIVOTS = 32
#: Regions cut in one round; their pivots travel to all tasks.
AT_ONCE = 64
#: A region whose cut makes more rows than this many times its own is joined in blocks.
MOST_COPIES = 3
#: Shingles a part of the shuffle holds, about.
PART = 750_000
#: One text in SAMPLE, chosen by hash, tells which shingles are frequent: those in 3 sampled sets.
SAMPLE, TIMES, FREQUENT = 8, 3, 1 << 20
FLUSH = 500_000
#: Bytes of text that are cut at once, and shingles that a batch of sets holds, about: a worker keeps what it once used.
CUT, SENT = 500_000, 500_000


def linked(inter, union):
    return 100 * inter >= 75 * union


def first_shingles(n):
    """How many of a set's first shingles a linked set must meet."""
    return n - (3 * n + 3) // 4 + 1


def least_overlap(x, y):
    """How many shingles linked sets of these sizes share at least."""
    return (3 * (x + y) + 6) // 7


def reach(n: int) -> int:
    """How many of a set's first shingles are sent."""
    return min(n, first_shingles(n) + EXTRA)


def text_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, int]]:
    """(row, sorted distinct shingles, node) of every text with words."""
    for first, data, at in chunks(texts, CUT):
        hashes, bounds = shingle_hashes(*word_hashes(data, at), SIZE)
        for r in range(len(at) - 1):
            if bounds[r] < bounds[r + 1]:
                own = np.unique(hashes[bounds[r] : bounds[r + 1]])
                yield first + r, own, _node(own)


def _node(own: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        whole = np.array([len(own)], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(whole).view(np.int64)[0])


def _batch(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in kinds.items()], list(kinds))


# --- 1: sets ----------------------------------------------------------------------------------


def sets_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, node, n, hash of the text) of every row; no node for texts without words."""
    kinds = {"id": pa.int64(), "node": pa.int64(), "n": pa.int64(), "h": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n = [None] * batch.num_rows, [0] * batch.num_rows
            for r, own, key in text_sets(batch.column(1)):
                node[r], n[r] = key, len(own)
            yield _batch({"id": batch.column(0).to_pylist(), "node": node, "n": n, "h": batch.column(2).to_pylist()}, kinds)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    return rows.mapInArrow(run, "id bigint, node bigint, n bigint, h bigint")


# --- 2: singleton pivots ----------------------------------------------------------------------


def _by_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each shingle, from other bits than the order uses."""
    return (mix(hashes) % np.uint64(parts)).astype(np.int64)


class _Blobs:
    """Packed (shingle, node, size, and with ``places`` place in the node's order) rows by part, sent out when many have come together."""

    def __init__(self, parts: int, limit: int | None = None, places: bool = False):
        self.parts, self.limit, self.places = parts, limit, places
        self.rows: list[tuple[np.ndarray, int, int, int]] = []
        self.held, self.nodes = 0, set()

    def add(self, shingles: np.ndarray, node: int, n: int, first: int = 0) -> None:
        """first: the place of the first of these shingles."""
        if node not in self.nodes:  # copies within reach are sent once
            self.nodes.add(node)
            self.rows.append((shingles, node, n, first))
            self.held += len(shingles)

    def out(self) -> Iterator[tuple[int, bytes]]:
        if self.held:
            shingles = np.concatenate([r[0] for r in self.rows])
            size = [len(r[0]) for r in self.rows]
            node = np.repeat(np.array([r[1] for r in self.rows], np.int64), size)
            n = np.repeat(np.array([r[2] for r in self.rows], np.int32), size)
            sent = [shingles, node, n]
            if self.places:
                sent.append(np.concatenate([np.arange(r[3], r[3] + len(r[0]), dtype=np.int32) for r in self.rows]))
            part = _by_part(shingles, self.parts)
            order = np.argsort(shingles, kind="stable")
            if self.limit:
                # A shingle in more nodes than a small region may have is sent just often enough to
                # show that, however many documents hold it.
                s = shingles[order]
                new = np.r_[True, s[1:] != s[:-1]]
                start = np.flatnonzero(new)
                order = order[np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)])) <= self.limit]
            order = order[np.argsort(part[order], kind="stable")]
            ends = np.searchsorted(part[order], np.arange(self.parts + 1))
            for p in range(self.parts):
                at = order[ends[p] : ends[p + 1]]
                if len(at):
                    yield p, b"".join(x[at].tobytes() for x in sent)
        self.rows, self.held, self.nodes = [], 0, set()


def _unpacked(blobs: pa.ChunkedArray, places: bool = False) -> list[np.ndarray]:
    kinds = [np.uint64, np.int64, np.int32, np.int32][: 3 + places]
    size, columns = sum(np.dtype(x).itemsize for x in kinds), [[] for _ in kinds]
    for blob in blobs:
        data = memoryview(blob.as_buffer())
        k, at = len(data) // size, 0
        for column, kind in zip(columns, kinds):
            column.append(np.frombuffer(data[at : (at := at + k * np.dtype(kind).itemsize)], kind))
    s, node, *rest = (np.concatenate(x) for x in columns)
    order = np.lexsort((node, s))
    s, node = s[order], node[order]
    once = np.r_[True, (s[1:] != s[:-1]) | (node[1:] != node[:-1])]  # copies of other tasks
    return [s[once], node[once], *(x[order][once] for x in rest)]


BLOB = "part int, blob binary"
_BLOB = {"part": pa.int32(), "blob": pa.binary()}


def _blob_batches(blobs: _Blobs) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for row in blobs.out():
        rows.append(row)
        held += len(row[1])
        if held > 8 * SENT:
            yield _batch({"part": [r[0] for r in rows], "blob": [r[1] for r in rows]}, _BLOB)
            rows, held = [], 0
    if rows:
        yield _batch({"part": [r[0] for r in rows], "blob": [r[1] for r in rows]}, _BLOB)


def frequent_shingles(docs: DataFrame, text_col: str, parts: int) -> np.ndarray:
    """Sorted shingles that many sets hold, at most ``FREQUENT``, judged on sampled texts."""
    sample = docs.select(F.col(text_col).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = _Blobs(parts, TIMES)
        for batch in batches:
            for _, own, node in text_sets(batch.column(0)):
                blobs.add(own, node, len(own))
                if blobs.held > FLUSH:
                    yield from _blob_batches(blobs)
        yield from _blob_batches(blobs)

    def count(table: pa.Table) -> pa.Table:
        s, _, _ = _unpacked(table.column("blob"))
        shingle, times = np.unique(s, return_counts=True)
        often = times >= TIMES
        return pa.table({"shingle": shingle[often].view(np.int64), "times": times[often]})

    counted = sample.mapInArrow(send, BLOB).groupBy("part").applyInArrow(count, "shingle bigint, times bigint")
    top = counted.orderBy(F.desc("times"), "shingle").limit(FREQUENT).select("shingle").toArrow()
    return np.sort(top.column("shingle").to_numpy().view(np.uint64).copy())


def held_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def candidates(docs: DataFrame, text_col: str, frequent: np.ndarray, parts: int, small: int) -> DataFrame:
    """(a, b): pairs that may be linked; (a, null): nodes left to the counted order."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(frequent)  # at most FREQUENT numbers

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = _Blobs(parts, small, places=True)
        for batch in batches:
            for _, own, node in text_sets(batch.column(0)):
                often = held_in(own, known.value)
                rare, first = own[~often], reach(len(own))
                # A negative size marks a node whose first shingles reach the frequent ones.
                blobs.add(rare[:first].copy(), node, -len(own) if len(rare) < first else len(own))
                if blobs.held > FLUSH or len(blobs.nodes) > FLUSH:
                    yield from _flush(blobs)
        yield from _flush(blobs)

    def _flush(blobs: _Blobs) -> Iterator[pa.RecordBatch]:
        dense = [r[1] for r in blobs.rows if r[2] < 0]
        # Part -1: nodes for the counted order.
        if dense:
            blob = np.array(dense, np.int64).tobytes()
            yield _batch({"part": [-1 - (dense[0] % parts)], "blob": [blob]}, _BLOB)
        yield from _crowded(blobs)
        yield from _blob_batches(blobs)

    def _crowded(blobs: _Blobs) -> Iterator[pa.RecordBatch]:
        """Nodes of regions that are too large within one task already."""
        if not blobs.held:
            return
        shingles = np.concatenate([r[0] for r in blobs.rows])
        node = np.repeat(np.array([r[1] for r in blobs.rows], np.int64), [len(r[0]) for r in blobs.rows])
        order = np.argsort(shingles, kind="stable")
        s = shingles[order]
        start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        size = np.diff(np.r_[start, len(s)])
        large = np.repeat(size > small, size)
        nodes = np.unique(node[order][large])
        if len(nodes):
            yield _batch({"part": [-1 - int(nodes[0] % parts)], "blob": [nodes.tobytes()]}, _BLOB)

    def pairs(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part < 0:
            return _pairs(np.unique(np.concatenate([np.frombuffer(b.as_buffer(), np.int64) for b in table.column("blob")])))
        s, node, n, place = _unpacked(table.column("blob"), places=True)
        start, size = _runs(s)
        large = np.unique(node[np.repeat(size > small, size)])
        return _pairs(large, *_early_pairs(node, n, place, start, size, small))

    texts = docs.select(F.col(text_col).alias("text"))
    return _meeting_often(texts.mapInArrow(send, BLOB).groupBy("part").applyInArrow(pairs, PAIRS))


PAIRS = "a bigint, b bigint, na bigint, nb bigint, times bigint"


def _runs(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts, and its length."""
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    return start, np.diff(np.r_[start, len(s)])


def _early_pairs(node: np.ndarray, n: np.ndarray, place: np.ndarray, start: np.ndarray, size: np.ndarray, small: int) -> tuple[np.ndarray, ...]:
    """(a, b, na, nb, times): pairs within the regions of at most ``small`` nodes, and in how many they stand early in both.

    Of linked sets of x and y shingles, x lacks at most x - overlap of its own. So one of its first x - overlap + 1 is
    shared, and of its first x - overlap + 1 + EXTRA so many more. The set whose first ones end earlier in the order has
    what it shares among the other's first ones.
    """
    names, local = np.unique(node, return_inverse=True)
    sizes = np.zeros(len(names), np.int64)
    sizes[local] = n
    codes = []
    for g in range(2, small + 1):
        rows = start[size == g]
        for block in np.array_split(rows, max(1, len(rows) * g * g // 4_000_000)):
            if len(block):
                at = block[:, None] + np.arange(g)
                i, j = np.triu_indices(g, 1)
                i, j = at[:, i].ravel(), at[:, j].ravel()
                x, y = abs(n[i].astype(np.int64)), abs(n[j].astype(np.int64))
                room = 1 + EXTRA - least_overlap(x, y)
                fits = (3 * np.maximum(x, y) <= 4 * np.minimum(x, y)) & (place[i] < x + room) & (place[j] < y + room)
                codes.append(np.stack(np.unique(local[i[fits]] * len(names) + local[j[fits]], return_counts=True)))
    if not codes:
        return (), (), (), (), ()
    code, times = np.concatenate(codes, axis=1)
    code, back = np.unique(code, return_inverse=True)
    times = np.bincount(back, times, len(code)).astype(np.int64)
    a, b = code // len(names), code % len(names)
    return names[a], names[b], sizes[a], sizes[b], times


def _pairs(alone, a=(), b=(), na=(), nb=(), times=()) -> pa.Table:
    none = np.zeros(len(alone), np.int64)
    valid = pa.array([None] * len(alone), pa.int64())
    column = lambda x: pa.array(np.asarray(x, np.int64))
    return pa.table(
        {
            "a": pa.chunked_array([column(alone), column(a)]),
            "b": pa.chunked_array([valid, column(b)]),
            "na": pa.chunked_array([column(none), column(na)]),
            "nb": pa.chunked_array([column(none), column(nb)]),
            "times": pa.chunked_array([column(none), column(times)]),
        }
    )


def _meeting_often(found: DataFrame) -> DataFrame:
    """(a, b) of the pairs that meet as often as linked sets must, and (a, null)."""
    both = found.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("times").alias("times"))
    overlap = F.floor((3 * (F.abs("na") + F.abs("nb")) + 6) / 7)
    # Of a node that reaches the frequent shingles only the others were counted, so it is kept.
    often = F.col("times") >= F.least(F.lit(1 + EXTRA), overlap)
    return both.filter(F.col("b").isNull() | (F.col("na") < 0) | (F.col("nb") < 0) | often).select("a", "b")


# --- 3: singleton pivots in a counted order ----------------------------------------------------


def rarest_first(nodes: DataFrame) -> DataFrame:
    """(node, n, first, alone): a node's first shingles that other nodes hold too, in the counted order, and how many of its own come before."""
    each = nodes.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count("*").alias("times")).filter("times > 1")
    shared = each.join(held, "shingle").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    sent = F.least("n", F.col("n") - F.floor((3 * F.col("n") + 3) / 4) + 1 + EXTRA)
    ordered = shared.select("node", "n", alone.alias("alone"), F.slice("shared.shingle", 1, F.greatest(sent - alone, F.lit(0)).cast("int")).alias("first"))
    return ordered.filter(F.size("first") > 0)


def close_candidates(nodes: DataFrame, parts: int, small: int) -> DataFrame:
    """(a, b): pairs of (node, shingles) whose connected parts hold all linked nodes together."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = _Blobs(parts, places=True)
        for batch in batches:
            for node, n, alone, first in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                blobs.add(first.values.to_numpy().view(np.uint64).copy(), node, n, alone)
                if blobs.held > FLUSH:
                    yield from _blob_batches(blobs)
        yield from _blob_batches(blobs)

    def pairs(table: pa.Table) -> pa.Table:
        s, node, n, place = _unpacked(table.column("blob"), places=True)
        start, size = _runs(s)
        a, b, na, nb, times = _early_pairs(node, n, place, start, size, small)
        # A large region: by size, each node with the next one. Linked sizes lie within 4/3, and so do those between.
        large = np.repeat(size > small, size)
        region, m, w, early = np.repeat(np.arange(len(size)), size)[large], n[large].astype(np.int64), node[large], place[large]
        order = np.lexsort((m, region))
        region, m, w, early = region[order], m[order], w[order], early[order]
        fits = early < m + 1 + EXTRA - least_overlap(m, _least_other(region, m))
        region, m, w = region[fits], m[fits], w[fits]
        near = (region[1:] == region[:-1]) & (3 * m[1:] <= 4 * m[:-1])
        x, y = w[:-1][near], w[1:][near]
        kept = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
        none = np.zeros(kept.shape[1], np.int64)
        return _pairs((), *(np.concatenate(z) for z in ((a, kept[0]), (b, kept[1]), (na, none), (nb, none), (times, none + 1 + EXTRA))))

    rows = rarest_first(nodes).select("node", "n", "alone", "first")
    return _meeting_often(rows.mapInArrow(send, BLOB).groupBy("part").applyInArrow(pairs, PAIRS))


def _least_other(region: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least size that a linked set of another row in the region may have; rows are sorted by region, then size."""
    least, span = (3 * m + 3) // 4, int(m.max(initial=0)) + 1
    key = region * span + m
    at = np.searchsorted(key, region * span + least)
    at += at == np.arange(len(m))  # not the row itself
    held = np.minimum(at, len(m) - 1)
    there = (at < len(m)) & (region[held] == region)
    return np.where(there, m[held], 2 * span)


def close_links(spark: SparkSession, nodes: DataFrame, parts: int, small: int, region: int) -> DataFrame:
    """Links (a, b) that connect what is linked within (node, shingles)."""
    family = staged(components(staged(close_candidates(nodes, parts, small))))
    named = family.select("node", F.shiftrightunsigned(F.xxhash64("root"), 4).alias("region"))
    return voronoi_links(spark, staged(named.join(nodes, "node").select("region", "node", "shingles")), region)


# --- 4 and 5: document pivots -------------------------------------------------------------------


def overlaps(pivot: np.ndarray, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shingles that each of the joined sets shares with a pivot; no set is empty."""
    return np.add.reduceat(held_in(flat, pivot), at[:-1], dtype=np.int64) if len(at) > 1 else np.zeros(0, np.int64)


def _bit_rows(flat: np.ndarray, at: np.ndarray) -> np.ndarray | None:
    """A row of bits for each set, over the shingles that several of them hold; None where that is more than the sets."""
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    column = (np.cumsum(times > 1) - 1)[place]
    width = (int((times > 1).sum()) + 63) // 64
    if not width or width * (len(at) - 1) > 2 * len(flat):
        return None
    held = times[place] > 1
    column = column[held]
    code = np.repeat(np.arange(len(at) - 1), np.diff(at))[held] * width + (column >> 6)
    start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    rows = np.zeros((len(at) - 1) * width, np.uint64)
    rows[code[start]] = np.add.reduceat(np.uint64(1) << (column & 63).astype(np.uint64), start)
    return rows.reshape(-1, width)


def link_region(sets: list[np.ndarray], radius: float = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what is linked within a region, found pivot by pivot."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sets = [sets[i] for i in order]
    n = np.array([len(s) for s in sets], np.int64)
    if not len(n):
        return []
    flat, at = np.concatenate(sets), np.r_[0, np.cumsum(n)]
    label, done, links = np.arange(len(n)), np.zeros(len(n), bool), []
    bits = _bit_rows(flat, at)

    def shared(p: int, others: np.ndarray) -> np.ndarray:
        if bits is None:
            return overlaps(sets[p], np.concatenate([sets[r] for r in others]), np.r_[0, np.cumsum(n[others])])
        inter = np.empty(len(others), np.int64)
        for k in range(0, len(others), 256):  # what a worker's cache holds
            inter[k : k + 256] = np.bitwise_count(bits[others[k : k + 256]] & bits[p]).sum(axis=1, dtype=np.int64)
        inter[others == p] = n[p]  # the set itself has shingles that no other holds
        return inter

    def join(p: int, others: np.ndarray) -> None:
        for x in others:
            if label[x] != label[p]:
                links.append((order[p], order[int(x)]))
                label[label == label[x]] = label[p]

    for p in range(len(n)):
        if done[p]:
            continue
        done[p] = True
        # All sets within twice the radius: their sizes are within 1 - 2 * radius of the pivot's.
        low, high = np.searchsorted(n, (1 - 2 * radius) * n[p] - 1e-9), np.searchsorted(n, n[p] / (1 - 2 * radius) + 1e-9, "right")
        inter = shared(p, np.arange(low, high))
        union = n[low:high] + n[p] - inter
        away = 1 - inter / union
        ball = np.flatnonzero(linked(inter, union)) + low
        join(p, ball)
        outer = np.flatnonzero(~linked(inter, union) & (away <= 2 * radius + 1e-9)) + low
        for x in ball[~done[ball]]:
            rivals = outer[(away[outer - low] <= radius + away[x - low] + 1e-9) & (label[outer] != label[x])]
            if len(rivals):
                inter_x = shared(int(x), rivals)
                join(int(x), rivals[linked(inter_x, n[rivals] + n[x] - inter_x)])
            done[x] = True
    return links


LINK = "a bigint, b bigint"


def _leaf(table: pa.Table) -> pa.Table:
    node = table.column("node").to_pylist()
    first = {k: i for i, k in reversed(list(enumerate(node)))}  # a node that came twice
    at = list(first.values())
    column = table.column("shingles").combine_chunks()
    sets = [column[i].values.to_numpy().view(np.uint64) for i in at]
    links = link_region(sets)
    return pa.table(
        {
            "a": pa.array([node[at[i]] for i, _ in links], pa.int64()),
            "b": pa.array([node[at[j]] for _, j in links], pa.int64()),
        }
    )


def _classes_of(sets: list[np.ndarray]) -> list[int]:
    """The class of each pivot, by the links between pivots."""
    label = list(range(len(sets)))
    for i, own in enumerate(sets):
        for k in range(i):
            inter = int(held_in(own, sets[k]).sum())
            if label[k] != label[i] and linked(inter, len(own) + len(sets[k]) - inter):
                label = [label[i] if x == label[k] else x for x in label]
    return label


def _cut(members: DataFrame, regions: list[int], next_region: int) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Voronoi regions of document pivots: rows (region, node, shingles, loose), and (null region, a, b) links.

    A node linked to the pivot of its region is in that pivot's class, and goes to earlier pivots of other classes
    only. All others are loose, and go to later pivots too whose linked nodes they may be linked with, those within
    twice the radius. So two linked nodes meet in a region or are in one class by their pivots. Boundary nodes are
    loose where they go; a region without loose nodes is in one class whole.
    """
    rank = Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(next_region)), "node")
    chosen = (
        members.filter(F.col("region").isin(regions))
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= PIVOTS)
        .select("region", "node", "shingles")
        .toArrow()
    )
    pivots: dict[int, list[tuple[int, np.ndarray]]] = {r: [] for r in regions}
    for region, node, shingles in zip(
        chosen.column("region").to_pylist(), chosen.column("node").to_pylist(), chosen.column("shingles").combine_chunks()
    ):
        pivots[region].append((node, shingles.values.to_numpy().view(np.uint64).copy()))
    classes = {r: _classes_of([x for _, x in own]) for r, own in pivots.items()}
    names = {(r, k): next_region + i * (PIVOTS + 1) + k + 1 for i, r in enumerate(regions) for k in range(-1, len(pivots[r]))}
    sent = members.sparkSession.sparkContext.broadcast((pivots, classes, names))
    kinds = {"region": pa.int64(), "node": pa.int64(), "shingles": pa.list_(pa.int64()), "loose": pa.bool_(), "a": pa.int64(), "b": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, classes, names = sent.value
        for batch in batches:
            out: dict[str, list] = {k: [] for k in kinds}
            held = 0

            def put(region, node, shingles, loose, a=None, b=None):
                for k, v in zip(kinds, (region, node, shingles, loose, a, b)):
                    out[k].append(v)

            for region, node, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = cell.values.to_numpy().view(np.uint64)
                away, joined = np.ones(len(pivots[region])), set()
                for k, (other, shingles) in enumerate(pivots[region]):
                    inter = int(held_in(own, shingles).sum())
                    union = len(own) + len(shingles) - inter
                    away[k] = 1 - inter / union
                    if linked(inter, union):
                        joined.add(k)
                        if other != node:
                            put(None, None, None, None, node, other)
                # Region -1 is the one of all that share nothing with any pivot; it lies at
                # distance 1 of everything.
                home = int(away.argmin()) if len(away) and away.min() < 1 else -1
                least = away[home] if home >= 0 else 1.0
                mine = own.view(np.int64)
                loose = home not in joined
                put(names[region, home], node, mine, loose)
                near = [k for k in range(max(home, 0)) if away[k] <= least + 2 * RADIUS + 1e-9 and (loose or classes[region][k] != classes[region][home])]
                if loose and home >= 0:
                    near += [k for k in range(home + 1, len(away)) if away[k] <= 2 * RADIUS + 1e-9]
                for k in near:
                    put(names[region, k], node, mine, True)
                if home >= 0 and least >= 1 - RADIUS - 1e-9:
                    put(names[region, -1], node, mine, True)
                held += len(own) * (1 + len(near))
                if held > SENT:
                    yield _batch(out, kinds)
                    out, held = {k: [] for k in kinds}, 0
            yield _batch(out, kinds)

    rows = members.filter(F.col("region").isin(regions)).select("region", "node", "shingles")
    cut = rows.mapInArrow(run, "region bigint, node bigint, shingles array<bigint>, loose boolean, a bigint, b bigint")
    return cut, names


def _blocks(members: DataFrame, regions: list[int], sizes: dict[int, int], limit: int) -> DataFrame:
    """Links of regions that pivots do not cut: all pairs of blocks, each in a task of its own."""
    count = F.create_map(*(F.lit(x) for r in regions for x in (r, max(2, -(-2 * sizes[r] // limit)))))
    rows = members.filter(F.col("region").isin(regions)).withColumn("blocks", F.element_at(count, F.col("region")))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = rows.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
    return pair.select("region", "x", "y", "node", "shingles").groupBy("region", "x", "y").applyInArrow(_leaf, LINK)


def voronoi_links(spark: SparkSession, nodes: DataFrame, limit: int = REGION) -> DataFrame:
    """Links (a, b) within (region, node, shingles), cutting regions of more than ``limit`` nodes."""
    members, links = nodes, spark.createDataFrame([], LINK)
    next_region, parents = 0, {}
    while True:
        counted = members.groupBy("region").count()
        large = counted.filter(F.col("count") > limit).orderBy(F.desc("count")).limit(AT_ONCE).collect()
        if not large:
            return links.unionByName(members.groupBy("region").applyInArrow(_leaf, LINK))
        low = members.agg(F.max("region")).first()[0]
        next_region = max(next_region, low) + 1
        sizes = {r["region"]: r["count"] for r in large}
        # A region that kept most of its parent's nodes is not cut any further.
        stuck = [r for r, c in sizes.items() if r in parents and c > 0.8 * parents[r]]
        fresh = [r for r in sizes if r not in stuck]
        rest = members.filter(~F.col("region").isin(list(sizes)))
        if stuck:
            links = links.unionByName(_blocks(members, stuck, sizes, limit))
        if fresh:
            cut, names = _cut(members, fresh, next_region)
            cut = staged(cut)
            counts = cut.filter("a is null").groupBy("region").agg(F.count("*").alias("count"), F.max("loose").alias("loose"))
            # Without loose nodes a region is one class, known by its links to the pivot.
            own = {r["region"]: r["count"] if r["loose"] else 0 for r in counts.collect()}
            total = {r: sum(own.get(name, 0) for (x, _), name in names.items() if x == r) for r in fresh}
            # Where most nodes are boundary nodes of most pivots, cutting only multiplies them.
            vain = [r for r in fresh if total[r] > MOST_COPIES * sizes[r]]
            if vain:
                links = links.unionByName(_blocks(members, vain, sizes, limit))
            dropped = [name for (r, _), name in names.items() if r in vain or not own.get(name, 0)]
            parents |= {name: sizes[r] for (r, _), name in names.items()}
            links = links.unionByName(cut.filter("a is not null").select("a", "b"))
            kept = cut.filter("a is null").filter(~F.col("region").isin(dropped)) if dropped else cut.filter("a is null")
            rest = rest.unionByName(kept.select("region", "node", "shingles"))
        members = rest


# --- the join -----------------------------------------------------------------------------------


def join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    small: int = SMALL,
    region: int = REGION,
    part: int = PART,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    known, by_node = _classes(docs, id_col, text_col, small, region, part)
    out = known.join(by_node.drop("root"), "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _classes(docs: DataFrame, id_col: str, text_col: str, small: int = SMALL, region: int = REGION, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """(id, node, n, h) of every row, and (node, root, component_id): the root names the class of a node."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = staged(sets_of(docs, "id", "text"))
    nodes = known.filter("node is not null and id is not null").groupBy("node").agg(F.min("id").alias("id"), F.max("n").alias("n"))
    total = nodes.agg(F.sum("n")).first()[0] or 0
    frequent = frequent_shingles(docs, "text", 1 + total // SAMPLE // part)
    found = staged(candidates(docs, "text", frequent, 1 + total // 4 // part, small))
    family = staged(components(found.filter("b is not null")))
    size = family.groupBy("root").count()
    # Families within bounds are regions of their own; region 0 has the nodes left to the counted order.
    crowded = size.filter(F.col("count") > region).select("root")
    dense = found.filter("b is null").select(F.col("a").alias("node"))
    dense = dense.unionByName(family.join(crowded, "root", "left_semi").select("node")).distinct()
    dense = dense.select(F.lit(0).cast("long").alias("region"), "node")
    names = size.join(crowded, "root", "left_anti").select("root", F.abs(F.xxhash64("root")).alias("region"))
    kept = family.join(names, "root").select("region", "node")
    asked = staged(dense.unionByName(kept))
    shingles = staged(_sets_of_nodes(docs, asked.select("node").distinct().join(nodes, "node")))
    rows = asked.join(shingles, "node")
    links = rows.filter("region <> 0").groupBy("region").applyInArrow(_leaf, LINK)
    in_region_0 = staged(rows.filter("region = 0").select("node", "shingles"))
    shingled = in_region_0.agg(F.sum(F.size("shingles"))).first()[0] or 0
    links = links.unionByName(close_links(spark, in_region_0, 1 + shingled // 4 // part, small, region))
    classes = components(links)
    roots = nodes.select("node", "id").join(classes, "node", "left").select(
        "node", "id", F.coalesce("root", "node").alias("root")
    )
    least = staged(roots.groupBy("root").agg(F.min("id").alias("component_id")))
    return known, staged(roots.join(least, "root").select("node", "root", "component_id"))


def _sets_of_nodes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (node, id, n), read from the texts again."""
    texts = docs.join(wanted.select("id", "node"), "id").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"node": pa.int64(), "shingles": pa.list_(pa.int64())}
        for batch in batches:
            asked, out, held = batch.column(0).to_pylist(), {"node": [], "shingles": []}, 0
            for r, own, node in text_sets(batch.column(1)):
                if node == asked[r]:  # an id may have other texts
                    out["node"].append(node)
                    out["shingles"].append(own.view(np.int64))
                    held += len(own)
                if held > SENT:
                    yield _batch(out, kinds)
                    out, held = {"node": [], "shingles": []}, 0
            yield _batch(out, kinds)

    return texts.mapInArrow(run, "node bigint, shingles array<bigint>").dropDuplicates(["node"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """Exactly one row of each class, that with the least id, then the least hash of its text.

    Rows without a class stay: those without words, and those with a null id. All columns are kept. Of
    rows with one id and text, the one with the least hash of its columns stays.
    """
    known, by_node = _classes(docs, id_col, text_col, **bounds)
    rows = known.filter("node is not null and id is not null")
    best = rows.groupBy("node").agg(F.min(F.struct("id", "h")).alias("best")).join(by_node, "node")
    best = best.groupBy("root").agg(F.min("best").alias("best")).select("best.id", "best.h", F.lit(True).alias("stays"))
    marked = rows.groupBy("id", "h").agg(F.count("*").alias("copies")).join(best, ["id", "h"], "left")
    # Only rows that go, and those that repeat the one that stays.
    marked = staged(marked.filter("stays is null or copies > 1").select(F.col("id").alias("_class_id"), F.col("h").alias("_class_h"), "stays"))

    def same(marks: DataFrame):
        return (docs[id_col].cast("long") == marks["_class_id"]) & (F.xxhash64(docs[text_col]) == marks["_class_h"])

    gone = marked.select("_class_id", "_class_h")
    single = docs.join(gone, same(gone), "left_anti")
    repeated = marked.filter("stays").select("_class_id", "_class_h")
    if repeated.isEmpty():
        return single
    copies = docs.join(repeated, same(repeated), "left_semi")
    hashed = [docs[f.name] for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    order = Window.partitionBy(docs[id_col].cast("long"), F.xxhash64(docs[text_col])).orderBy(F.xxhash64(*hashed))
    one = copies.withColumn("_class_copy", F.row_number().over(order)).filter("_class_copy = 1")  # a task sends one row of a group
    return single.unionByName(one.drop("_class_copy"))
