"""Ranked lexical search by per-term geometric blocking, exact.

Documents are indexed in cells of at most ``CELL`` rows. A cell holds its documents' vectors (terms and
their saturated counts) and, for every term, the posting list cut into blocks of similar documents: a few
documents of the list stand as centres, and each document joins the centre with the largest inner product
of the vectors' random projections. A block stores the coordinatewise maximum of its documents' vectors.
The inner product of an item with that summary is an upper bound for every document in the block, so a
block is skipped only if its bound lies under a score that ``k`` documents are known to reach; a list is
skipped if all lists up to it together stay under that score.

A first pass scores, in every cell, the documents of an item's rarest terms and gives every item the score of its
k-th best document so far, its floor. The lists that an item may need to reach its floor are then cut into blocks and
written as the index, and the search opens all blocks whose bounds reach the floor, which rises further inside a
task. A task sends at most ``k`` rows per item.

Items are searched in blocks of about ``TERMS`` (item, term) pairs, the most that the driver holds and
broadcasts at once; an item with more terms makes a block by itself. Only terms of the block's items are indexed, since no others
are ever read, and a summary holds the coordinates that occur in an item together with the block's term.
Statistics (documents, terms, document frequencies) cover all rows.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, only A-Z
lower-cased; a hash proposes a term and its bytes decide.

Cases: null texts have no terms; documents without terms are not counted. Rows of one item id make up
one item; null item ids are an id of their own. Repeated rows are documents of their own and give rows
of their own. Equal scores go by id, null ids first. Items that match nothing give no row; empty tables give
none. Other columns are not read. Long texts are read whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from vellum.llm.common import ascii_lower, staged
from vellum.llm.words import chunks, word_places

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
TERMS = 8192
CELL, CELL_VALUES = 2048, 16_777_216
#: Documents per block in short lists; long lists have about 2/3 of a root of their length as blocks.
BLOCK = 16
PROJECTED = 32
_BLANK = np.ones(256, bool)
_BLANK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


# --- items ---------------------------------------------------------------------------------------


@dataclass
class Vocabulary:
    """Terms of a block of items, their hashes in order, and the terms of each item."""

    terms: list[bytes]
    items: list
    item_terms: list[np.ndarray]
    hashes: np.ndarray = field(init=False)
    by_hash: np.ndarray = field(init=False)
    lengths: np.ndarray = field(init=False)

    def __post_init__(self):
        data = np.frombuffer(b"".join(self.terms), np.uint8)
        self.lengths = np.array([len(t) for t in self.terms], np.int64)
        at = np.concatenate([[0], np.cumsum(self.lengths)])
        hashes = word_places(data, at, np.zeros(256, bool))[0]
        self.by_hash = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.by_hash]

    def find(self, hashes: np.ndarray, first: np.ndarray, length: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The term of each word, or -1. Terms of equal hash are all tried."""
        found = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes):
            return found
        place = np.searchsorted(self.hashes, hashes)
        open_ = np.flatnonzero(place < len(self.hashes))
        while len(open_):
            open_ = open_[self.hashes[place[open_]] == hashes[open_]]
            term = self.by_hash[place[open_]]
            same = self.lengths[term] == length[open_]
            for n in np.unique(length[open_[same]]):
                of = np.flatnonzero(same & (length[open_] == n))
                kinds, which = np.unique(term[of], return_inverse=True)
                table = np.frombuffer(b"".join(self.terms[k] for k in kinds), np.uint8).reshape(len(kinds), n)
                at = first[open_[of]]
                equal = np.ones(len(of), bool)
                for j in range(n):
                    equal &= low[at + j] == table[which, j]
                same[of] = equal
            found[open_[same]] = term[same]
            open_ = open_[~same]
            place[open_] += 1
            open_ = open_[place[open_] < len(self.hashes)]
        return found


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term), each once."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    return items.select(F.col(item_col).alias("item"), F.explode(words).alias("term")).distinct()


def _vocabulary(pairs: DataFrame) -> Vocabulary:
    rows = pairs.collect()
    terms = sorted({r["term"] for r in rows})
    number = {t: i for i, t in enumerate(terms)}
    own: dict = {}
    for r in rows:
        own.setdefault(r["item"], []).append(number[r["term"]])
    items = sorted(own, key=_order)
    return Vocabulary([t.encode() for t in terms], items, [np.array(sorted(own[i])) for i in items])


def _order(key) -> tuple:
    """Nulls first, then by value."""
    return (key is not None, key if key is not None else 0)


# --- document vectors ------------------------------------------------------------------------------


def _pickled(*arrays: np.ndarray) -> tuple[bytes, int]:
    data = pickle.dumps(arrays, 5)
    return pa.compress(data, "zstd", asbytes=True), len(data)


def _opened(blob: bytes, size: int) -> tuple[np.ndarray, ...]:
    return pickle.loads(pa.decompress(blob, size, "zstd", asbytes=True))


def cells(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ids, data, size, docs, words): documents in cells; ids and data are of those that hold a term.

    ``data`` holds where each document's vector starts, its terms, counts and word numbers; ``docs`` and
    ``words`` count all documents with words.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    out = StructType([StructField("ids", ArrayType(kind)), StructField("data", BinaryType()), StructField("size", LongType()), StructField("docs", LongType()), StructField("words", LongType())])
    most = max(1, min(CELL, CELL_VALUES // max(len(vocab.terms), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        counted = [0, 0]

        def cell() -> pa.RecordBatch:
            ids = pa.concat_arrays([x[0] for x in held]) if held else pa.array([], id_type)
            parts = [np.concatenate([x[k] for x in held]) if held else np.zeros(0, np.int64) for k in (1, 2, 3, 4)]
            data, size = _pickled(np.concatenate([[0], np.cumsum(parts[0])]), *parts[1:])
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            batch = [lists, pa.array([data], pa.binary()), *(pa.array([x], pa.int64()) for x in (size, *counted))]
            held.clear()
            counted[:] = [0, 0]
            return pa.RecordBatch.from_arrays(batch, out.names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for row, data, at in chunks(batch.column(1)):
                hashes, first, bounds, low, word = word_places(data, at, _BLANK)
                length = np.add.reduceat(word, first, dtype=np.int64) if len(first) else first
                n = np.diff(bounds)
                term = vocab.find(hashes, first, length, low)
                owner = np.repeat(np.arange(len(n)), n)[term >= 0]
                key, tf = np.unique(owner * len(vocab.terms) + term[term >= 0], return_counts=True)
                owner, term = (key // len(vocab.terms), key % len(vocab.terms)) if len(key) else (key, key)
                counted[0] += int((n > 0).sum())
                counted[1] += int(n.sum())
                holders, count = np.unique(owner, return_counts=True)
                start = np.concatenate([[0], np.cumsum(count)])
                done = 0
                while done < len(holders):
                    step = min(most - sum(len(x[0]) for x in held), len(holders) - done)
                    part = slice(start[done], start[done + step])
                    ids = batch.column(0).take(pa.array(holders[done : done + step] + row))
                    held.append((ids, count[done : done + step], term[part].astype(np.int32), tf[part].astype(np.int32), n[holders[done : done + step]]))
                    done += step
                    if sum(len(x[0]) for x in held) >= most:
                        yield cell()
        if held or counted[0]:
            yield cell()

    return rows.mapInArrow(run, out)


@dataclass
class Statistics:
    docs: int
    words: int
    weights: np.ndarray


def statistics(found: DataFrame, n_terms: int) -> Statistics:
    """Over all cells: documents, words, and each term's weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for blob, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                df += np.bincount(_opened(blob, size)[1], minlength=n_terms)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(df[term])], ["term", "df"])

    totals = found.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    docs, words = int(totals["docs"] or 0), int(totals["words"] or 0)
    held = found.select("data", "size").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    return Statistics(docs, words, np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64))


# --- index -----------------------------------------------------------------------------------------


@dataclass
class Cell:
    """Vectors by document, and blocks by term with their summaries.

    ``start``, ``terms``, ``x``: vectors; ``lists``: first block of each term; ``block_start``,
    ``block_docs``: documents of each block; ``keys``, ``tops``: summaries as (block * terms + coordinate, maximum).
    Stored keys are the steps from one to the next.
    """

    start: np.ndarray
    terms: np.ndarray
    x: np.ndarray
    lists: np.ndarray
    block_start: np.ndarray
    block_docs: np.ndarray
    keys: np.ndarray
    tops: np.ndarray

    def packed(self) -> tuple[bytes, int]:
        steps = np.diff(self.keys, prepend=0).astype(np.uint32)
        return _pickled(self.start, self.terms, self.x, self.lists, self.block_start, self.block_docs, steps, self.tops)

    @classmethod
    def unpacked(cls, blob: bytes, size: int) -> Cell:
        *most, steps, tops = _opened(blob, size)
        return cls(*most, np.cumsum(steps, dtype=np.int64), tops)


def saturated(tf: np.ndarray, n: np.ndarray, stats: Statistics) -> np.ndarray:
    """A term's count after saturation and length; a score is the sum of weight times this."""
    m = 100 - 50 + (50 * n * stats.docs) // max(stats.words, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def most_per_term(terms: np.ndarray, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The most that each term gives to a document of a cell."""
    most = np.zeros(len(weights), np.int64)
    np.maximum.at(most, terms, x)
    return most * weights


def needed_terms(own: np.ndarray, most: np.ndarray, floor: int) -> np.ndarray:
    """The item's terms without which no document of a cell reaches the floor."""
    order = np.argsort(most[own], kind="stable")
    return own[order][np.cumsum(most[own][order]) >= max(floor, 1)]


def build_cell(start: np.ndarray, terms: np.ndarray, x: np.ndarray, vocab: Vocabulary, weights: np.ndarray, floors: np.ndarray) -> Cell:
    """Cut the posting lists that some item needs into blocks of similar documents and take their maxima."""
    n, v = len(start) - 1, len(vocab.terms)
    owner = np.repeat(np.arange(n), np.diff(start))
    directions = np.random.default_rng(0).standard_normal((v, PROJECTED)).astype(np.float32)
    values = np.zeros((n, v), np.int32)
    values[owner, terms] = x
    low = values.astype(np.float32) @ directions
    low /= np.maximum(np.linalg.norm(low, axis=1, keepdims=True), 1e-9)
    by_term = np.argsort(terms, kind="stable")
    in_order, list_start = owner[by_term], np.searchsorted(terms[by_term], np.arange(v + 1))
    most = most_per_term(terms, x, weights)
    needing: dict[int, list[np.ndarray]] = {}
    for own, floor in zip(vocab.item_terms, floors.tolist()):
        for t in needed_terms(own, most, floor).tolist():
            needing.setdefault(t, []).append(own)
    lists, block_start, block_docs, keys, tops = np.zeros(v + 1, np.int64), [0], [], [], []
    for t in range(v):
        own = in_order[list_start[t] : list_start[t + 1]] if t in needing else ()
        size = len(own)
        if size:
            count = max(1, min(-(-size // BLOCK), int(size**0.5 / 1.5)))
            if count > 1:
                centres = own[(np.arange(count) * size) // count]
                block = (low[own] @ low[centres].T).argmax(axis=1)
                order = np.argsort(block, kind="stable")
                own, block = own[order], block[order]
                cut = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
            else:
                cut = np.zeros(1, np.int64)
            with_t = np.unique(np.concatenate(needing[t]))
            top = np.maximum.reduceat(values[np.ix_(own, with_t)], cut, axis=0)
            at, coordinate = np.nonzero(top)
            keys.append((at + len(block_start) - 1) * v + with_t[coordinate])
            tops.append(top[at, coordinate])
            block_start.extend((block_start[-1] + np.append(cut[1:], size)).tolist())
            block_docs.append(own)
        lists[t + 1] = len(block_start) - 1
    empty = [np.zeros(0, np.int64)]
    return Cell(
        start, terms, x.astype(np.int32), lists, np.array(block_start),
        np.concatenate(block_docs or empty).astype(np.int32), np.concatenate(keys or empty), np.concatenate(tops or empty).astype(np.int32),
    )


def _vectors(blob: bytes, size: int, stats: Statistics) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, terms and saturated counts of a stored cell."""
    start, terms, tf, n = _opened(blob, size)
    return start, terms, saturated(tf.astype(np.int64), np.repeat(n, np.diff(start)), stats)


def index(found: DataFrame, vocab: Vocabulary, stats: Statistics, floors: np.ndarray) -> DataFrame:
    """(ids, data, size): every cell with the blocks and summaries that items need beyond their floors."""
    rows = found.filter(F.size("ids") > 0).select("ids", "data", "size")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                vectors = _vectors(batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), stats)
                data, size = build_cell(*vectors, vocab, stats.weights, floors).packed()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([data], pa.binary()), pa.array([size], pa.int64())], names
                )

    return rows.mapInArrow(run, rows.schema)


# --- search ----------------------------------------------------------------------------------------


def _ranges(start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the given rows of a row-start array, and where each row's places begin."""
    count = start[which + 1] - start[which]
    first = np.concatenate([[0], np.cumsum(count)])
    return np.repeat(start[which] - first[:-1], count) + np.arange(first[-1]), first


class Vectors:
    """The vectors of a cell, for exact scores."""

    def __init__(self, start: np.ndarray, terms: np.ndarray, x: np.ndarray, weights: np.ndarray):
        self.start, self.terms, self.x, self.weights = start, terms, x, weights
        self.of_item = np.zeros(len(weights), np.int64)

    def scores(self, own: np.ndarray, docs: np.ndarray) -> np.ndarray:
        if not len(docs):
            return np.zeros(0, np.int64)
        at, first = _ranges(self.start, docs)
        self.of_item[own] = self.weights[own]
        total = np.add.reduceat(self.of_item[self.terms[at]] * self.x[at], first[:-1])
        self.of_item[own] = 0
        return total


class Rarest:
    """A cell's documents that hold an item's heaviest terms, enough of them to set a floor."""

    def __init__(self, start: np.ndarray, terms: np.ndarray, x: np.ndarray, weights: np.ndarray):
        self.vectors = Vectors(start, terms, x, weights)
        by_term = np.argsort(terms, kind="stable")
        self.docs = np.repeat(np.arange(len(start) - 1), np.diff(start))[by_term]
        self.lists = np.searchsorted(terms[by_term], np.arange(len(weights) + 1))

    def best(self, own: np.ndarray, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        rare = own[np.argsort(-self.vectors.weights[own], kind="stable")]
        size = np.cumsum(self.lists[rare + 1] - self.lists[rare])
        rare = rare[: int(np.searchsorted(size, 2 * k)) + 1]
        docs = np.unique(self.docs[_ranges(self.lists, rare)[0]])
        score = self.vectors.scores(own, docs)
        keep = score >= max(floor, 1)
        return docs[keep], score[keep]


class Searcher:
    """One cell opened for search; counts the blocks and documents that it looks at."""

    def __init__(self, cell: Cell, weights: np.ndarray):
        self.c, self.weights, self.v = cell, weights, len(weights)
        self.most = most_per_term(cell.terms, cell.x, weights)
        self.vectors = Vectors(cell.start, cell.terms, cell.x, weights)
        self.blocks = self.opened = self.scored = 0

    def bounds(self, own: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, bound) of the lists that are needed to reach the floor."""
        block, _ = _ranges(self.c.lists, needed_terms(own, self.most, floor))
        if not len(block):
            return block, block
        own = own[self.most[own] > 0]
        key = block[:, None] * self.v + own
        at = np.minimum(np.searchsorted(self.c.keys, key), len(self.c.keys) - 1)
        return block, np.where(self.c.keys[at] == key, self.c.tops[at], 0) @ self.weights[own]

    def best(self, own: np.ndarray, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that reach the floor, all found in the blocks that can."""
        block, bound = self.bounds(own, floor)
        can = block[bound >= max(floor, 1)]
        docs = np.unique(self.c.block_docs[_ranges(self.c.block_start, can)[0]])
        self.blocks += len(block)
        self.opened += len(can)
        self.scored += len(docs)
        score = self.vectors.scores(own, docs)
        keep = score >= max(floor, 1)
        return docs[keep], score[keep]


def _best(found: DataFrame, vocab: Vocabulary, floors: np.ndarray, k: int, opener) -> DataFrame:
    """(n, id, score): per task at most ``k`` documents of each item, by its number.

    ``opener(data, size)`` gives a cell's ``best``.
    """
    kind = found.schema["ids"].dataType.elementType
    out = StructType([StructField("n", IntegerType()), StructField("id", kind), StructField("score", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in vocab.items]
        floor = floors.copy()
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type.value_type
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                rank = np.empty(len(ids), np.int64)
                rank[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
                cell = opener(batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                for q, own in enumerate(vocab.item_terms):
                    docs, score = cell.best(own, int(floor[q]), k)
                    if len(docs):
                        first = np.lexsort((rank[docs], -score))[:k]
                        best[q].extend((-int(s), _order(ids[int(d)].as_py())) for d, s in zip(docs[first], score[first]))
                        best[q] = sorted(best[q])[:k]
                        if len(best[q]) == k:
                            floor[q] = max(floor[q], -best[q][-1][0])
        rows = [(q, i[1] if i[0] else None, -s) for q, own_best in enumerate(best) for s, i in own_best]
        if rows:
            columns = zip(*rows)
            types = [pa.int32(), id_type, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], out.names)

    return found.filter(F.size("ids") > 0).select("ids", "data", "size").mapInArrow(run, out)


def _search_block(docs: DataFrame, vocab: Vocabulary, k: int, id_col: str, text_col: str) -> DataFrame:
    """(n, id, score, rank) of one block of items."""
    found = staged(cells(docs, vocab, id_col, text_col))
    stats = statistics(found, len(vocab.terms))
    weights = stats.weights
    place = F.row_number().over(Window.partitionBy("n").orderBy(F.desc("score"), F.asc_nulls_first("id")))
    floors = np.zeros(len(vocab.items), np.int64)
    first = _best(found, vocab, floors, k, lambda data, size: Rarest(*_vectors(data, size, stats), weights))
    for r in first.withColumn("rank", place).filter(F.col("rank") == k).collect():
        floors[r["n"]] = r["score"]
    built = staged(index(found, vocab, stats, floors))
    ranked = _best(built, vocab, floors, k, lambda data, size: Searcher(Cell.unpacked(data, size), weights))
    return ranked.withColumn("rank", place).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    pairs = staged(item_terms(items, item_col, text_col))
    blocks = max(1, -(-pairs.count() // TERMS))
    parts = None
    for b in range(blocks):
        vocab = _vocabulary(pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b))
        if not vocab.items:
            continue
        names = spark.createDataFrame(
            list(enumerate(vocab.items)), StructType([StructField("n", IntegerType()), StructField("item", pairs.schema["item"].dataType)])
        )
        part = _search_block(docs, vocab, k, id_col, text_col).join(names, "n").select(
            F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"
        )
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        empty = StructType([StructField(item_col, pairs.schema["item"].dataType), StructField("rank", IntegerType()),
                            StructField(id_col, docs.schema[id_col].dataType), StructField("score", LongType())])
        return spark.createDataFrame([], empty)
    return parts
