"""Language-model scores from a hierarchical Pitman-Yor model.

A word follows its context restaurant, that of the word before it; every word is a context, and the end
token is the context of a text's first word. All context restaurants share one parent, the root, whose
base is uniform over the known types and one unknown. Tables are customers of the root. Seating is
sampled by Gibbs: one sweep takes all customers of a (context, word) out and seats them again, given all
others; predictive probabilities are averaged over the sweeps after the first.

All tokens of all training texts are counted. Words are spread by hash over parts, and each part seats
its words: a word's customers in all contexts and in the root meet there. A part needs of its contexts
only the totals: it sends its own numbers by bucket of contexts and gets the sums over all parts back,
at the start and after the first sweep. Within a job a part sees its own changes of the totals at once
and those of others after it.

Heavy words are spread over the parts by context as well, and a part knows how many customers the other
parts send to the root. Heavy pairs of words are counted on the map side, seated as a part of their own,
and their probabilities travel to all tasks. Which words and pairs count as heavy comes from one pass over
all tokens and changes where the work is done, not the model.

Cases: null and empty texts are the end token alone. Repeated rows count, and are scored, each.
A null id is never held out. Without training tokens every token has the base probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import staged, staged_by
from vellum.llm.words import chunks, mix, word_hashes

#: At most so many words and pairs, about, are heavy.
HEAVY = 4096
PART = 1_500_000
SWEEPS = 4
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.5, 1.0
SEED = 20_240_601
END = int(mix(np.array([0xE7D], np.uint64))[0].view(np.int64))


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, remainder 1 of 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


# --- tokens -----------------------------------------------------------------------------------


def tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, token of each place, where each row's tokens start); each row ends with END."""
    for first, data, at in chunks(texts):
        hashes, bounds = word_hashes(data, at)
        rows = len(at) - 1
        starts = bounds + np.arange(rows + 1)
        out = np.empty(len(hashes) + rows, np.int64)
        is_end = np.zeros(len(out), bool)
        is_end[starts[1:] - 1] = True
        out[is_end] = END
        out[~is_end] = hashes.view(np.int64)
        yield first, out, starts


def places(values: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array, or its length."""
    at = np.minimum(np.searchsorted(top, values), len(top) - 1)
    return np.where(top[at] == values, at, len(top))


def contexts_of(found: np.ndarray) -> np.ndarray:
    """Context of each token: the token before it; every row ends with END, so END comes before a row."""
    return np.r_[np.array([END], np.int64), found[:-1]]


def pair_keys(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each (word, context)."""
    return mix(mix(word.view(np.uint64)) + context.view(np.uint64)).view(np.int64)


class Heavy:
    """Sorted heavy words, and heavy pairs in the order of their keys."""

    def __init__(self, words: np.ndarray, word: np.ndarray, context: np.ndarray):
        self.words, keys = np.sort(words), pair_keys(word, context)
        order = np.argsort(keys)
        self.keys, self.word, self.context = keys[order], word[order], context[order]


def heavy(rows: DataFrame, tokens_about: int, parts: int) -> Heavy:
    """Words and pairs with more tokens than about an eighth of a part.

    What holds a share of all tokens holds at least half that share in runs of rows with half of its
    tokens or more, so a run sends only what is frequent in itself.
    """
    shares = 2 * min(HEAVY, 8 * parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found, _ in tokens(batch.column(0)):
                word, code, times = np.unique(found, return_inverse=True, return_counts=True)
                least = max(1, len(found) // shares)
                often = times >= least
                both = np.flatnonzero(often[code[1:]] & often[code[:-1]]) + 1
                pair, each = np.unique(code[both] * len(word) + code[both - 1], return_counts=True)
                pair, each = pair[each >= least], each[each >= least]
                none = pa.nulls(int(often.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[word[often], word[pair // len(word)]]), pa.concat_arrays([none, pa.array(word[pair % len(word)])]), pa.array(np.r_[times[often], each])],
                    ["word", "context", "times"],
                )

    if parts == 1:
        none = np.zeros(0, np.int64)
        return Heavy(none, none, none)
    counted = rows.select("text").mapInArrow(count, "word bigint, context bigint, times bigint").groupBy("word", "context").agg(F.sum("times").alias("times"))
    got = counted.filter(F.col("times") >= max(1, tokens_about // shares)).select("word", "context").collect()  # about 2 * shares rows
    column = lambda name, own: np.array([r[name] for r in got if (r["context"] is None) == own], np.int64)
    return Heavy(column("word", True), column("word", False), column("context", False))


# --- seating ----------------------------------------------------------------------------------


def seat(rng: np.random.Generator, customers: np.ndarray, discount: float, strength: np.ndarray) -> np.ndarray:
    """Tables that customers of each dish open, one after the other.

    strength: (theta + d * other tables of the restaurant) * parent probability of the dish. From the
    65th customer on, as many sit down at once as make up a 64th of those seated.
    """
    tables = (customers > 0).astype(np.int32)
    active = np.flatnonzero(customers > 1)
    seated = 1
    while len(active):
        some = max(1, seated // 64)
        n, t, fresh = customers[active], tables[active], strength[active]
        chance = fresh / (seated - discount * t + fresh)
        tables[active] += rng.binomial(np.minimum(some, n - seated), np.clip(chance, 0, 1))
        seated += some
        active = active[n > seated]
    return tables


class Totals:
    """Customers and tables of the context restaurants, and those of the root, over all parts.

    others: root customers of each of a part's words that come from other parts.
    """

    def __init__(self, customers: np.ndarray, tables: np.ndarray, root_customers: float, root_tables: float, types: int, others: np.ndarray | int = 0):
        self.customers, self.tables = customers.astype(float), tables.astype(float)
        self.root_customers, self.root_tables, self.types = float(root_customers), float(root_tables), types
        self.others = others


def sweeps(
    word: np.ndarray,
    context: np.ndarray,
    count: np.ndarray,
    alone: np.ndarray,
    totals: Totals,
    part: int,
    rounds: int,
    later: Totals | None = None,
) -> dict[str, np.ndarray]:
    """Gibbs sweeps over a part's pairs.

    word, context, count: training customers of each pair; alone: customers of each word that go to
    the root directly; totals: those before the first sweep, and ``later`` those of all parts after it
    (the first sweep of a part is the same whenever it runs). Gives tables per pair, root customers and tables per word after the last sweep,
    and the averages of the pairs' and words' predictive probabilities over all sweeps after the first.
    """
    rng = np.random.default_rng([SEED, part & 0x7FFFFFFF])
    words, base = len(alone), 1.0 / (totals.types + 1)
    direct, alone = alone, alone + totals.others
    tables = (count > 0).astype(np.int32)
    customers = alone + np.bincount(word, tables, words).astype(np.int64)
    root_tables = (customers > 0).astype(np.int64)
    own_context, own_root, own_root_tables = totals.tables.copy(), totals.root_customers, totals.root_tables
    pair_p, word_p, kept = np.zeros(len(word)), np.zeros(words), 0

    def root() -> np.ndarray:
        below = ROOT_STRENGTH + own_root
        return (np.maximum(customers - ROOT_DISCOUNT * root_tables, 0) + (ROOT_STRENGTH + ROOT_DISCOUNT * own_root_tables) * base) / below

    for n in range(rounds):
        p = root()
        strength = (STRENGTH + DISCOUNT * np.maximum(own_context[context] - tables, 0)) * p[word]
        again = seat(rng, count, DISCOUNT, strength)
        own_context = own_context + np.bincount(context, again - tables, len(own_context))
        tables = again
        fresh = alone + np.bincount(word, tables, words).astype(np.int64)
        own_root, customers = own_root + float((fresh - customers).sum()), fresh
        seats = seat(rng, customers, ROOT_DISCOUNT, (ROOT_STRENGTH + ROOT_DISCOUNT * np.maximum(own_root_tables - root_tables, 0)) * base)
        own_root_tables, root_tables = own_root_tables + float((seats - root_tables).sum()), seats
        if not n and later:
            own_context, own_root, own_root_tables = later.tables.copy(), later.root_customers, later.root_tables
            alone = direct + later.others
            customers = alone + np.bincount(word, tables, words).astype(np.int64)
        if n or rounds == 1:
            p, kept = root(), kept + 1
            word_p += p
            pair_p += (np.maximum(count - DISCOUNT * tables, 0) + (STRENGTH + DISCOUNT * own_context[context]) * p[word]) / (
                STRENGTH + totals.customers[context]
            )
    return {
        "tables": tables, "customers": customers, "root_tables": root_tables,
        "pair_p": pair_p / max(kept, 1), "word_p": word_p / max(kept, 1),
    }


# --- parts ------------------------------------------------------------------------------------

#: run: the rows that were dealt at once; docs: all of them, sent with one part only; names: the distinct words and
#: contexts of a blob; rest: which of its k documents are for training, their numbers of tokens, their places in the run
#: as steps, and the places in ``names`` of its n words and of their contexts, packed.
SENT = "part int, run bigint, docs binary, names binary, rest binary, n int, k int"
#: Tokens that are dealt to the parts at once: the more, the fewer names are sent again.
DEALT = 1_500_000


def _runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``tokens`` of more rows at once."""
    held, first, size = [], 0, 0
    for start, found, starts in tokens(texts):
        if not held:
            first = start
        held.append((found, starts))
        size += len(found)
        if size >= DEALT:
            yield first, *_joined(held)
            held, size = [], 0
    if held:
        yield first, *_joined(held)


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.concatenate([np.diff(starts) for _, starts in held])
    return np.concatenate([found for found, _ in held]), np.r_[0, np.cumsum(sizes)]


def _code_type(names: int) -> type:
    return np.uint16 if names <= 1 << 16 else np.uint32


def _run_key(rows: np.ndarray, task: int, run: int) -> int:
    own = mix(rows.view(np.uint64) + mix(np.arange(len(rows), dtype=np.uint64))).sum(dtype=np.uint64)
    return int(mix(mix(np.array([own ^ np.uint64(task)], np.uint64)) + np.uint64(run)).view(np.int64)[0])


def _send(rows: DataFrame, hot: Heavy, parts: int) -> DataFrame:
    """Tokens but those of heavy pairs, by part: words and contexts, document by document."""
    known = rows.sparkSession.sparkContext.broadcast(hot)  # at most some HEAVY words and pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, runs = known.value, 0
        for batch in batches:
            doc, train = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for first, found, starts in _runs(batch.column(2)):
                context = contexts_of(found)
                row = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
                own, rest = mix(found.view(np.uint64)), np.arange(len(found))
                if len(hot.words):
                    spread = np.flatnonzero(places(found, hot.words) < len(hot.words))
                    keys = pair_keys(found[spread], context[spread])
                    own[spread] = mix(keys.view(np.uint64))
                    if len(hot.keys):
                        rest = np.delete(rest, spread[places(keys, hot.keys) < len(hot.keys)])
                part = (own[rest] % np.uint64(parts)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                ends = np.searchsorted(part[order], np.arange(parts + 1))
                out = []
                # Told by task and number, so that rows which come again are a run of their own, and by content, so
                # that a task which runs again over other rows cannot be mistaken.
                run = _run_key(doc[first : first + len(starts) - 1], TaskContext.get().partitionId(), runs)
                runs += 1
                for p in range(parts):
                    own = rest[order[ends[p] : ends[p + 1]]]
                    if len(own):
                        docs, sizes = np.unique(row[own], return_counts=True)
                        names, codes = np.unique(np.r_[found[own], context[own]], return_inverse=True)
                        steps = np.diff(docs, prepend=0).astype(np.int32)
                        rest_of = train[first + docs].tobytes() + sizes.astype(np.int32).tobytes() + steps.tobytes() + codes.astype(_code_type(len(names))).tobytes()
                        out.append([p, run, None, names.tobytes(), pa.compress(rest_of, "zstd", asbytes=True), len(own), len(docs)])
                if out:
                    out[run % len(out)][2] = doc[first : first + len(starts) - 1].tobytes()
                    columns = list(zip(*out))
                    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "run", "docs", "names", "rest", "n", "k"]
                    )

    return rows.select("row", "train", "text").mapInArrow(run, SENT)


#: Contents of a part. ends: where the contexts of each bucket end; shared, heavy: places of the heavy
#: words among the part's words and among all heavy words; docs: places of the documents in their runs, as steps; runs,
#: each: the runs and how many documents of them; homes, held, rows: the runs of which all rows are kept here, how many, which.
KINDS = {"word": np.int32, "context": np.int32, "count": np.int32, "names": np.int64, "ends": np.int32, "shared": np.int32, "heavy": np.int32,
         "docs": np.int32, "sizes": np.int32, "pairs": np.int32, "runs": np.int64, "each": np.int32, "homes": np.int64, "held": np.int32, "rows": np.int64}
PACKED = "part int, n bigint, v bigint, seen bigint, words bigint, " + ", ".join(f"{k} binary" for k in KINDS)
SEATED = ("word", "context", "count", "names", "ends", "shared", "heavy")
DEALT_OUT = ("docs", "sizes", "runs", "each", "homes", "held", "rows")


def _contents(part: int, words: np.ndarray, contexts: np.ndarray, hot: Heavy, buckets: int, count=None, learn=None, dealt=()) -> dict:
    """A packed part, from its pairs with counts, or from its tokens and which of them are training ones."""
    found, word = np.unique(words, return_inverse=True)
    names, context = np.unique(contexts, return_inverse=True)
    bucket = (mix(names.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    code, pair = np.unique(word * len(names) + back[context], return_inverse=True)
    count = np.bincount(pair[learn], minlength=len(code)) if count is None else np.bincount(pair, count, len(code)).astype(np.int64)
    word, context = code // max(len(names), 1), code % max(len(names), 1)
    at = places(found, hot.words) if len(hot.words) else np.zeros(len(found), int)
    shared = np.flatnonzero(at < len(hot.words))
    total = np.bincount(word, count, len(found))
    total[shared] = 0
    ends = np.searchsorted(bucket[order], np.arange(buckets), "right")
    out = {"word": word, "context": context, "count": count, "names": names[order], "ends": ends, "shared": shared, "heavy": at[shared],
           "pairs": pair if learn is not None else ()} | dict(zip(DEALT_OUT, dealt or ((),) * len(DEALT_OUT)))
    return {"part": part, "n": int(count.sum()), "v": int((total > 0).sum()), "seen": int((count > 0).sum()), "words": len(found)} | {k: np.asarray(out[k]).astype(t).tobytes() for k, t in KINDS.items()}


PACKED_TYPES = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("v", pa.int64()), ("seen", pa.int64()), ("words", pa.int64()), *((k, pa.binary()) for k in KINDS)])


def _pack(hot: Heavy, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        docs, train, sizes, words, contexts = [], [], [], [], []
        for own_names, rest, n, k in zip(*(table.column(c) for c in ("names", "rest", "n", "k"))):
            n, k, names = n.as_py(), k.as_py(), np.frombuffer(own_names.as_buffer(), np.int64)
            kind = np.dtype(_code_type(len(names)))
            raw = np.frombuffer(pa.decompress(rest.as_buffer(), 9 * k + 2 * n * kind.itemsize, "zstd"), np.uint8)
            train.append(raw[:k].view(bool))
            sizes.append(raw[k : 5 * k].copy().view(np.int32))
            docs.append(raw[5 * k : 9 * k].copy().view(np.int32))
            codes = raw[9 * k :].copy().view(kind)
            words.append(names[codes[:n]])
            contexts.append(names[codes[n:]])
        docs, train, sizes, words, contexts = map(np.concatenate, (docs, train, sizes, words, contexts))
        runs, each = table.column("run").to_numpy(), table.column("k").to_numpy()
        kept = [(r, np.frombuffer(x.as_buffer(), np.int64)) for r, x in zip(runs, table.column("docs")) if x.is_valid]
        rows = np.concatenate([np.zeros(0, np.int64), *(x for _, x in kept)])
        part, learn = table.column("part")[0].as_py(), np.repeat(train, sizes)
        dealt = (docs, sizes, runs, each, [r for r, _ in kept], [len(x) for _, x in kept], rows)
        return pa.Table.from_pylist([_contents(part, words, contexts, hot, buckets, None, learn, dealt)], PACKED_TYPES)

    return run


def _read(batch: pa.RecordBatch | pa.Table, r: int) -> dict[str, np.ndarray]:
    out = {k: np.frombuffer(batch.column(k)[r].as_buffer(), t) for k, t in KINDS.items() if k in batch.schema.names}
    return out | {k: batch.column(k)[r].as_py() for k in ("part", "words") if k in batch.schema.names}


# --- totals over all parts --------------------------------------------------------------------

TOTALS = "kind int, part int, bucket int, names binary, a binary, b binary"


def _by_bucket(kind: int, own: dict[str, np.ndarray], *numbers: np.ndarray) -> pa.RecordBatch:
    """A part's numbers of its contexts, one row for each bucket that has some."""
    starts, ends = np.r_[0, own["ends"][:-1]], own["ends"]
    full = np.flatnonzero(ends > starts)
    blobs = [[x[starts[b] : ends[b]].astype(np.int64).tobytes() for b in full] for x in (own["names"], *numbers)]
    blobs += [[None] * len(full)] * (3 - len(blobs))
    same = lambda x: pa.array(np.full(len(full), x, np.int32))
    return pa.RecordBatch.from_arrays(
        [same(kind), same(own["part"]), pa.array(full.astype(np.int32)), *(pa.array(b, pa.binary()) for b in blobs)], ["kind", "part", "bucket", "names", "a", "b"]
    )


def _summed(sent: DataFrame) -> DataFrame:
    """The sums over all parts, sent back to each part in the order it has its contexts in."""

    def add(table: pa.Table) -> pa.Table:
        names = [np.frombuffer(b.as_buffer(), np.int64) for b in table.column("names")]
        cuts = np.cumsum([len(x) for x in names])[:-1]
        _, back = np.unique(np.concatenate(names), return_inverse=True)
        out = {k: table.column(k) for k in ("kind", "part", "bucket")} | {"names": pa.nulls(table.num_rows, pa.binary())}
        for k in ("a", "b"):
            if table.column(k).null_count:
                out[k] = table.column(k)
                continue
            own = np.concatenate([np.frombuffer(b.as_buffer(), np.int64) for b in table.column(k)])
            sums = np.bincount(back, own).astype(np.int64)[back]
            out[k] = pa.array([x.tobytes() for x in np.split(sums, cuts)], pa.binary())
        return pa.table(out)

    return sent.groupBy("bucket").applyInArrow(add, TOTALS)


def _got(table: pa.Table, kind: int, name: str) -> np.ndarray:
    """Totals of a part's contexts, bucket after bucket."""
    rows = [(b.as_py(), x) for k, b, x in zip(table.column("kind"), table.column("bucket"), table.column(name)) if k.as_py() == kind]
    return np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x.as_buffer(), np.int64) for _, x in sorted(rows, key=lambda r: r[0]))])


def _start_sent(packed: DataFrame) -> DataFrame:
    """Customers of each part's contexts, and one table for each of their pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                own = _read(batch, r)
                size = len(own["names"])
                yield _by_bucket(0, own, np.bincount(own["context"], own["count"], size), np.bincount(own["context"], own["count"] > 0, size))

    return packed.select("part", "context", "count", "names", "ends").mapInArrow(run, TOTALS)


def _heavy_sums(frame: DataFrame, size: int) -> np.ndarray:
    """(heavy words, 2): sums of the parts' numbers, given as rows (heavy, a, b)."""
    out = np.zeros((size, 2))
    if size:
        for r in frame.groupBy("heavy").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect():
            out[r["heavy"]] = r["a"], r["b"]  # one row per heavy word
    return out


HEAVY_ROWS = "heavy int, a bigint, b bigint"


def _heavy_start(packed: DataFrame) -> DataFrame:
    """Training tokens and pairs of each part's heavy words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                own = _read(batch, r)
                each = [np.bincount(own["word"], x, own["words"])[own["shared"]].astype(np.int64) for x in (own["count"], own["count"] > 0)]
                yield pa.RecordBatch.from_arrays([pa.array(own["heavy"]), *map(pa.array, each)], ["heavy", "a", "b"])

    return packed.select("words", "word", "count", "shared", "heavy").mapInArrow(run, HEAVY_ROWS)


class World:
    """What all parts know: root totals, and tables of the heavy words, at the start and after the first sweep."""

    def __init__(self, types: int, root: tuple[float, float], heavy: np.ndarray):
        self.types, self.root, self.heavy = types, root, heavy

    def totals(self, own: dict[str, np.ndarray], customers: np.ndarray, tables: np.ndarray, seats: np.ndarray) -> Totals:
        """seats: the part's own tables of its pairs, at the time of these totals."""
        others = np.zeros(own["words"], np.int64)
        mine = np.bincount(own["word"], seats, own["words"])[own["shared"]]
        others[own["shared"]] = (self.heavy[own["heavy"]] - mine).astype(np.int64)
        return Totals(customers, tables, *self.root, self.types, others)


def _one_sweep(own: dict[str, np.ndarray], got: pa.Table, start: World) -> tuple[Totals, dict[str, np.ndarray]]:
    begin = start.totals(own, _got(got, 0, "a"), _got(got, 0, "b"), own["count"] > 0)
    return begin, sweeps(own["word"], own["context"], own["count"], np.zeros(own["words"], np.int64), begin, own["part"], 1)


def _first_sweep(packed: DataFrame, totals: DataFrame, start: World) -> DataFrame:
    """After one sweep of each part: kind 1, tables of its contexts; kind 2, tables of its heavy words;
    kind 3, its root customers and root tables."""

    def run(left: pa.Table, got: pa.Table) -> pa.Table:
        own = _read(left, 0)
        _, done = _one_sweep(own, got, start)
        mine = np.bincount(own["word"], done["tables"], own["words"])
        # The root tables of a heavy word count in each part by the share of its customers.
        share = np.divide(mine, done["customers"], out=np.zeros(len(mine)), where=done["customers"] > 0)
        root = np.array([mine.sum(), (done["root_tables"] * share).sum()])
        tables = np.bincount(own["context"], done["tables"], len(own["names"]))
        sent = _by_bucket(1, own, tables)
        more = [
            {"kind": 2, "part": own["part"], "names": own["heavy"].tobytes(), "a": mine[own["shared"]].astype(np.int64).tobytes()},
            {"kind": 3, "part": own["part"], "a": root.tobytes()},
        ]
        return pa.concat_tables([pa.Table.from_batches([sent]), pa.Table.from_pylist(more, sent.schema)])

    mine = packed.select("part", "words", *SEATED)
    return mine.groupBy("part").cogroup(totals.groupBy("part")).applyInArrow(run, TOTALS)


def _after_first(first: DataFrame, size: int) -> tuple[tuple[float, float], np.ndarray]:
    """(root customers and tables, tables of the heavy words) after the first sweep."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, a in zip(batch.column(0), batch.column(1)):
                at, own = np.frombuffer(names.as_buffer(), np.int32), np.frombuffer(a.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own), pa.array(own)], ["heavy", "a", "b"])

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([np.frombuffer(a.as_buffer(), float) for a in batch.column(0)]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(own[:, 0]), pa.array(own[:, 1])], ["a", "b"])

    got = first.filter("kind = 3").select("a").mapInArrow(root, "a double, b double").agg(F.sum("a"), F.sum("b")).first()
    heavy_tables = _heavy_sums(first.filter("kind = 2").select("names", "a").mapInArrow(tables, HEAVY_ROWS), size)[:, 0]
    return (got[0] or 0.0, got[1] or 0.0), heavy_tables


def _all_sweeps(own: dict[str, np.ndarray], got: pa.Table, start: World, later: World, rounds: int) -> dict[str, np.ndarray]:
    begin, once = _one_sweep(own, got, start)
    after = later.totals(own, begin.customers, _got(got, 1, "a"), once["tables"])
    return sweeps(own["word"], own["context"], own["count"], np.zeros(own["words"], np.int64), begin, own["part"], rounds, after)


def _pair_values(own: dict[str, np.ndarray], done: dict[str, np.ndarray], n: int, v: int, heavy_count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, base, log probability) of each of a part's pairs."""
    total = np.bincount(own["word"], own["count"], own["words"])
    total[own["shared"]] = heavy_count[own["heavy"]]
    total = total[own["word"]]
    return total > 0, np.log10((total + 0.5) / (n + 0.5 * (v + 1))), np.log10(done["pair_p"])


SCORED = "row bigint, known bigint, base double, score double"
RUN_SUMS = ["run", "rows", "steps", "known", "base", "score"]


def _score_parts(packed: DataFrame, totals: DataFrame, start: World, later: World, rounds: int, n: int, v: int, heavy_count: np.ndarray) -> DataFrame:
    """What the tokens of all parts add to each document."""

    def run(left: pa.Table, got: pa.Table) -> pa.Table:
        own = _read(left, 0)
        values = _pair_values(own, _all_sweeps(own, got, start, later, rounds), n, v, heavy_count)
        starts = np.r_[0, np.cumsum(own["sizes"])[:-1]]
        known, own_base, own_score = (np.add.reduceat(x[own["pairs"]], starts, dtype=float) for x in values)
        # Packed by run: a part and a run exchange one row, and the rows of a run one more.
        sums = (own["docs"], known.astype(np.uint32), own_base, own_score.astype(np.float32))
        cuts = np.r_[0, np.cumsum(own["each"])]
        blobs = [[x[cuts[i] : cuts[i + 1]].tobytes() for i in range(len(own["each"]))] for x in sums]
        sent = pa.table([pa.array(own["runs"]), pa.nulls(len(own["runs"]), pa.binary()), *(pa.array(b, pa.binary()) for b in blobs)], RUN_SUMS)
        cuts = np.r_[0, np.cumsum(own["held"])]
        rows = pa.array([own["rows"][cuts[i] : cuts[i + 1]].tobytes() for i in range(len(own["held"]))], pa.binary())
        return pa.concat_tables([sent, pa.table([pa.array(own["homes"]), rows, *(pa.nulls(len(rows), pa.binary()) for _ in sums)], RUN_SUMS)])

    def add(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x.as_buffer(), np.int64) for x in table.column("rows") if x.is_valid]
        if len(rows) != 1:
            raise ValueError("a run of documents came back in another order; score a table that gives its rows in the same order again")
        sums = np.zeros((3, len(rows[0])))
        for steps, *own in zip(*(table.column(c) for c in RUN_SUMS[2:])):
            if steps.is_valid:
                at = np.cumsum(np.frombuffer(steps.as_buffer(), np.int32))
                for x, values, kind in zip(sums, own, (np.uint32, np.float64, np.float32)):
                    x[at] += np.frombuffer(values.as_buffer(), kind)  # a document once
        return pa.table({"row": rows[0], "known": sums[0].astype(np.int64), "base": sums[1], "score": sums[2]})

    mine = packed.select("part", "words", *SEATED, "pairs", *DEALT_OUT).groupBy("part")
    sent = mine.cogroup(totals.groupBy("part")).applyInArrow(run, "run bigint, rows binary, steps binary, known binary, base binary, score binary")
    each = sent.groupBy("run").applyInArrow(add, SCORED)
    return each.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("known", "base", "score")))  # repeated rows may lie in several runs


# --- heavy pairs ------------------------------------------------------------------------------


def _heavy_at(found: np.ndarray, hot: Heavy) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of heavy pairs, places of their pairs)."""
    if not len(hot.keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = places(pair_keys(found, contexts_of(found)), hot.keys)
    own = np.flatnonzero(at < len(hot.keys))
    return own, at[own]


def _heavy_pairs(rows: DataFrame, hot: Heavy) -> np.ndarray:
    """Training counts of the heavy pairs."""
    out = np.zeros(len(hot.keys), np.int64)
    if not len(out):
        return out
    known = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(known.value.keys), np.int64)
        for batch in batches:
            for _, found, _ in tokens(batch.column(0)):
                held += np.bincount(_heavy_at(found, known.value)[1], minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["code", "times"])

    counted = rows.filter("train").select("text").mapInArrow(run, "code bigint, times bigint")
    for r in counted.groupBy("code").agg(F.sum("times").alias("times")).collect():
        out[r["code"]] = r["times"]
    return out


def _score_heavy(rows: DataFrame, hot: Heavy, values: tuple[np.ndarray, ...]) -> DataFrame:
    """What the tokens of heavy pairs add to each document, and its number of tokens."""
    sent = rows.sparkSession.sparkContext.broadcast((hot, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hot, values = sent.value
            for first, found, starts in tokens(batch.column(1)):
                own, at = _heavy_at(found, hot)
                doc = np.searchsorted(starts, own, "right") - 1
                sums = [np.bincount(doc, x[at], len(starts) - 1) for x in values]
                docs = batch.column(0).slice(first, len(starts) - 1)
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(np.diff(starts)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(float)), pa.array(sums[2].astype(float))],
                    ["row", "tokens", "known", "base", "score"],
                )

    return rows.select("row", "text").mapInArrow(run, "row bigint, tokens bigint, known bigint, base double, score double")


# --- scores -----------------------------------------------------------------------------------


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", contexts: int | None = None, part: int = PART, rounds: int = SWEEPS
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    contexts: into how many buckets the context restaurants are dealt for their totals; as many as there
    are parts, if not given. part: about how many tokens a part has. Neither bounds the model.
    """
    spark = docs.sparkSession
    text = F.coalesce(text_col, F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text).alias("row"), (~is_held_out(id_col)).alias("train"), text.alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // 6 // part  # at six bytes a token
    buckets = contexts or parts
    hot = heavy(keyed, size // 6, parts)
    packed = staged_by(_send(keyed, hot, parts).groupBy("part").applyInArrow(_pack(hot, buckets), PACKED), "part", parts, "zstd")
    every, top = packed, None
    if len(hot.keys):
        top = _contents(-1, hot.word, hot.context, hot, buckets, _heavy_pairs(keyed, hot))
        every = packed.unionByName(spark.createDataFrame([top], packed.schema))
    sums = every.agg(F.sum("n"), F.sum("v"), F.sum("seen")).first()
    heavy_count, heavy_tables = _heavy_sums(_heavy_start(every), len(hot.words)).T
    n, v = int(sums[0] or 0), int((sums[1] or 0) + (heavy_count > 0).sum())
    totals = staged(_summed(_start_sent(every)))
    # One table for each pair, and for each word in the root.
    start = World(v, (float(sums[2] or 0), float(v)), heavy_tables)
    first = staged(_first_sweep(every, totals, start))
    root, tables = _after_first(first, len(hot.words))
    later = World(v, root, tables)
    again = _summed(first.filter("kind = 1"))
    values = (np.zeros(0),) * 3
    if top:
        again = staged(again)
    both = totals.unionByName(again)
    if top:
        own = _read(pa.Table.from_pylist([top], PACKED_TYPES), 0)
        got = both.filter("part = -1").toArrow()  # totals of the contexts of heavy pairs
        at = _pair_values(own, _all_sweeps(own, got, start, later, rounds), n, v, heavy_count)
        found, names = np.unique(hot.word), own["names"]
        keys = pair_keys(found[own["word"]], names[own["context"]])
        values = tuple(x[np.argsort(keys)].astype(float) for x in at)
    near = _score_heavy(keyed, hot, values)
    far = _score_parts(packed, both.filter("part >= 0"), start, later, rounds, n, v, heavy_count)
    own = near.groupBy("row").agg(
        F.count("*").alias("copies"), F.max("tokens").alias("tokens"), F.max("known").alias("known"), F.max("base").alias("base"), F.max("score").alias("score")
    )
    # Rows repeated with id and text added to the parts once each.
    rest = far.select("row", F.col("known").alias("known2"), F.col("base").alias("base2"), F.col("score").alias("score2"))
    sums = staged(own.join(rest, "row", "left"))
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("copies")
    return keyed.select("id", "row", "train").join(sums, "row").select(
        F.col("id").alias(id_col),
        (~F.col("train")).alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + share("known2")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + share("base2")).alias("base_score"),
        (F.col("score") + share("score2")).alias("score"),
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token of the model and of the base, for held-out and training rows."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))
