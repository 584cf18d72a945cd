"""Removal of long repeated byte strings through run-length compressed suffix indexes.

Every window of ``LENGTH`` bytes belongs to one anchor: the k-gram in it with the least hash (leftmost
of equals). Equal windows have equal anchors at the same place, so only occurrences of one anchor need
to be compared. An occurrence's context is the text of all windows it anchors.

1. Anchors that occur once anywhere are dropped, and with them almost all unique text.
2. Occurrences with the same context repeat as a whole: one representative stays.
3. Different contexts of one anchor meet in a bucket. Its suffixes are sorted and a run-length
   compressed Burrows-Wheeler transform is built, with samples at the run heads and run ends only.
   Streaming over the text, the longest match of every place follows from the last sample: it falls
   by one from place to place until the next run head (or end). Places whose match, with the suffix
   before or after it in order, has ``LENGTH`` bytes are marked.
4. An anchor with more than ``CROWD`` different contexts is not collected: the hashes of its windows
   are spread over parts, and windows that occur twice there are marked.
5. Marks go back to all occurrences of a context; the union of marked windows is removed.

Texts that occur more than once, with at least ``LENGTH`` bytes, repeat as a whole. Matches are
judged on the input and never cross documents; occurrences may overlap and may lie in one document.
Hashes of texts, k-grams and contexts have 64 bits.

Cases: null and empty texts have no bytes and keep none. Repeated rows and null ids give one row each;
texts shorter than ``LENGTH`` stay whole. Ids that are not whole numbers raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import staged
from vellum.llm.words import chunks, mix

LENGTH = 400
GRAM = 32
#: Bits that hold a place within a text; texts of 2**PLACE bytes or more are cut into overlapping slices.
PLACE = 26
BUCKET = 400_000
CROWD = 500
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class _Powers:
    """Powers of the base and of its inverse, as far as they were needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``string_hash`` reads the hash of any substring."""
    up, _ = _POWERS.to(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def string_hash(total: np.ndarray, low, high) -> np.ndarray:
    _, down = _POWERS.to(len(total))
    return mix((total[high] - total[low]) * down[low])


def least_of_each(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values, by block-wise running minima."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, anchor, context hash, first window, last window) of each anchor in rows of bytes.

    Windows are counted from the row's start.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) < length:
        return none
    total = sums(data)
    grams = string_hash(total, np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1))
    mask = np.uint64((1 << PLACE) - 1)
    least = least_of_each((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    place = (least & mask).astype(np.int64)
    starts = np.arange(len(place))
    row = np.searchsorted(at, starts, "right") - 1
    inside = starts + length <= at[row + 1]
    starts, place, row = starts[inside], place[inside], row[inside]
    if not len(starts):
        return none
    head = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
    low, high = starts[head], starts[np.r_[head[1:], len(starts)] - 1]
    own = place[head]
    with np.errstate(over="ignore"):
        shape = ((own - low) * 1024 + high - low).astype(np.uint64)
        context = mix(string_hash(total, low, high + length) + shape * _BASE)
    row = row[head]
    return row, grams[own].view(np.int64), context.view(np.int64), low - at[row], high - at[row]


def _rows(texts: pa.Array, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of a text column, long texts in slices that overlap by all but one byte of a window."""
    for first, data, at in chunks(texts):
        step = (1 << PLACE) - length
        for low in range(0, max(len(data) - length + 1, 1), step):
            if len(data) > step + length:
                part = data[low : low + step + length - 1]
                row, a, c, lo, hi = anchors(part, np.array([0, len(part)]), length, gram)
                yield row + first, a, c, lo + low, hi + low
            else:
                row, a, c, lo, hi = anchors(data, at, length, gram)
                yield row + first, a, c, lo, hi


ANCHOR = "key bigint, a bigint, ctx bigint, lo bigint, hi bigint"


def anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            for row, a, ctx, lo, hi in _rows(batch.column(1), length, gram):
                columns = [pa.array(x) for x in (key[row], a, ctx, lo, hi)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "a", "ctx", "lo", "hi"])

    return texts.select("key", "text").mapInArrow(run, ANCHOR)


# --- the index --------------------------------------------------------------------------------


class RunIndex:
    """Run-length compressed BWT of a few strings, with samples at run heads and ends."""

    def __init__(self, strings: list[np.ndarray]):
        size = np.array([len(s) for s in strings], np.int64)
        data = np.concatenate(strings).astype(np.int64)
        n = len(data)
        end = np.repeat(np.cumsum(size), size)
        start = end - np.repeat(size, size)
        at = np.arange(n)

        def further(values: np.ndarray, step: int) -> np.ndarray:
            """Values ``step`` places on; 0 beyond the string's end."""
            to = at + step
            return np.where(to < end, values[np.minimum(to, n - 1)], 0)

        # Suffix order by doubling, from seven bytes on: 257**7 fits 63 bits.
        key = np.zeros(n, np.int64)
        for k in range(7):
            key = key * 257 + further(data + 1, k)
        self.steps, self.ranks, step = [], [], 7
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
        while True:
            self.steps.append(step)
            self.ranks.append(rank)
            if step >= size.max() or rank.max() == n:
                break
            rank = np.unique(rank * (n + 1) + further(rank, step), return_inverse=True)[1].astype(np.int64) + 1
            step *= 2
        order = np.argsort(rank, kind="stable")
        before = np.where(at > start, data[np.maximum(at - 1, 0)], -1 - at)  # a string's start equals nothing
        bwt = before[order]
        head = np.r_[True, bwt[1:] != bwt[:-1]]
        self.runs = int(head.sum())
        self.data, self.end, self.at = data, end, at
        # Samples: the match with the suffix before each run head, and after each run end.
        heads, ends = np.flatnonzero(head), np.flatnonzero(np.r_[head[1:], True])
        self.head_place, self.end_place = order[heads], order[ends]
        self.head_match = np.where(heads > 0, self._match(order[heads], order[heads - 1]), 0)
        self.end_match = np.where(ends < n - 1, self._match(order[ends], order[np.minimum(ends + 1, n - 1)]), 0)

    def _match(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes i and j."""
        i, j, n = i.copy(), j.copy(), len(self.data)
        first = i.copy()
        i_end, j_end = self.end[i], self.end[j]
        for step, rank in zip(reversed(self.steps), reversed(self.ranks)):
            same = (i + step <= i_end) & (j + step <= j_end)
            same &= rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)]
            i, j = i + step * same, j + step * same
        open_ = np.ones(len(i), bool)
        for _ in range(7):
            open_ &= (i < i_end) & (j < j_end)
            open_ &= self.data[np.minimum(i, n - 1)] == self.data[np.minimum(j, n - 1)]
            i, j = i + open_, j + open_
        return i - first

    def statistics(self) -> np.ndarray:
        """Longest match of every place with any other place, streamed from the samples."""
        best = np.zeros(len(self.data), np.int64)
        for place, match in ((self.head_place, self.head_match), (self.end_place, self.end_match)):
            sampled = np.full(len(self.data), -1, np.int64)
            sampled[place] = self.at[place] + match
            last = np.maximum.accumulate(np.where(sampled >= 0, self.at, 0))
            best = np.maximum(best, sampled[last] - self.at)
        return best


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """[first, last] of the runs of true values."""
    edge = np.diff(np.r_[False, flags, False].astype(np.int8))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


MARK = "a bigint, ctx bigint, low array<int>, high array<int>"
_MARK = pa.schema([("a", pa.int64()), ("ctx", pa.int64()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32()))])


def _marks(rows: list[tuple[int, int, np.ndarray]]) -> pa.Table:
    out = []
    for a, ctx, flags in rows:
        if flags.any():
            low, high = zip(*_ranges(flags))
            out.append({"a": a, "ctx": ctx, "low": low, "high": high})
    return pa.Table.from_pylist(out, _MARK)


def _indexed(length: int):
    def run(table: pa.Table) -> pa.Table:
        a, ctx = table.column("a").to_pylist(), table.column("ctx").to_pylist()
        strings = [np.frombuffer(b.as_buffer(), np.uint8) for b in table.column("bytes")]
        found = RunIndex(strings).statistics() >= length
        at = np.r_[0, np.cumsum([len(s) for s in strings])]
        return _marks([(a[r], ctx[r], found[at[r] : at[r + 1] - length + 1]) for r in range(len(strings))])

    return run


def _crowded(contexts: DataFrame, length: int, parts: int) -> DataFrame:
    """Marks of anchors with very many contexts: equal windows meet by hash, in packed rows."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = np.concatenate([np.frombuffer(b.as_buffer(), np.uint8) for b in batch.column(2)])
            total = sums(data)
            size = np.array([len(b.as_buffer()) for b in batch.column(2)])
            at = np.r_[0, np.cumsum(size)]
            count = size - length + 1
            row = np.repeat(np.arange(len(size)), count)
            window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            low = at[row] + window
            hashed = string_hash(total, low, low + length)
            a, ctx = (batch.column(k).to_numpy() for k in (0, 1))
            part = (hashed % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            out = []
            for p in range(parts):
                own = order[ends[p] : ends[p + 1]]
                if len(own):
                    r = row[own]
                    out.append((p, hashed[own].tobytes() + a[r].tobytes() + ctx[r].tobytes() + window[own].astype(np.int32).tobytes()))
            parts_, blobs = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(parts_, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    def meet(table: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for blob in table.column("blob"):
            data = memoryview(blob.as_buffer())
            n, low = len(data) // 28, 0
            for k, (kind, width) in enumerate(((np.uint64, 8), (np.int64, 8), (np.int64, 8), (np.int32, 4))):
                columns[k].append(np.frombuffer(data[low : low + width * n], kind))
                low += width * n
        hashed, a, ctx, window = map(np.concatenate, columns)
        _, back, times = np.unique(hashed, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[back] > 1)
        twice = twice[np.lexsort((window[twice], ctx[twice], a[twice]))]
        head = np.flatnonzero(np.r_[True, (a[twice][1:] != a[twice][:-1]) | (ctx[twice][1:] != ctx[twice][:-1])]) if len(twice) else []
        out = []
        for low, high in zip(head, [*head[1:], len(twice)]):
            w = window[twice[low:high]].tolist()
            out.append({"a": int(a[twice[low]]), "ctx": int(ctx[twice[low]]), "low": w, "high": w})
        return pa.Table.from_pylist(out, _MARK)

    sent = contexts.select("a", "ctx", "bytes").mapInArrow(send, "part int, blob binary")
    return sent.groupBy("part").applyInArrow(meet, MARK)


# --- removal ----------------------------------------------------------------------------------


def spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET, crowd: int = CROWD) -> DataFrame:
    """(key, spans): the removed [start, end) bytes of each text that has some; key: xxhash64 of the text."""
    texts = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")).filter(F.octet_length("text") >= length)
    copies = texts.groupBy("key").agg(F.count("*").alias("copies"), F.max(F.octet_length("text")).alias("size"))
    whole = copies.filter("copies > 1").select("key", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"))).alias("whole"))
    rows = staged(anchor_rows(texts, length, gram))
    # Least and greatest occurrence: combined on the map side, however often an anchor occurs.
    place = F.struct("key", "lo")
    often = rows.groupBy("a").agg(F.min(place).alias("x"), F.max(place).alias("y")).filter("x <> y").select("a")
    seen = staged(rows.join(staged(often), "a"))
    per_context = staged(
        seen.groupBy("a", "ctx").agg(F.min(F.struct("key", "lo", "hi")).alias("rep"), F.max(F.struct("key", "lo", "hi")).alias("last"))
    )
    variety = staged(per_context.groupBy("a").agg(F.count("*").alias("contexts")).filter("contexts > 1"))
    asked = per_context.join(variety, "a").select("a", "ctx", "contexts", "rep.key", "rep.lo", "rep.hi")
    contexts = staged(_context_bytes(texts, asked, length))
    volume = contexts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = 1 + volume // bucket
    small = contexts.filter(F.col("contexts") <= crowd).withColumn("bucket", F.pmod(F.xxhash64("a"), F.lit(buckets)))
    found = small.groupBy("bucket").applyInArrow(_indexed(length), MARK)
    found = found.unionByName(_crowded(contexts.filter(F.col("contexts") > crowd), length, 1 + volume // (4 * bucket)))
    # A context that occurs twice is marked as a whole.
    twice = per_context.filter("rep <> last").select(
        "a", "ctx", F.array(F.lit(0)).alias("low"), F.array((F.col("rep.hi") - F.col("rep.lo")).cast("int")).alias("high")
    )
    marks = found.unionByName(twice).groupBy("a", "ctx").agg(
        F.flatten(F.collect_list("low")).alias("low"), F.flatten(F.collect_list("high")).alias("high")
    )
    placed = seen.join(staged(marks), ["a", "ctx"]).select(
        "key", F.zip_with("low", "high", lambda x, y: F.struct((F.col("lo") + x).alias("start"), (F.col("lo") + y + length).alias("end"))).alias("s")
    )
    state = F.array().cast("array<struct<start:bigint,end:bigint>>")
    last = lambda acc: F.get(acc, F.size(acc) - 1)
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_set("s"))),
        state,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= last(acc)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    # A text's marks are bounded by its length.
    per_text = placed.groupBy("key").agg(merged.alias("marked"))
    return staged(per_text.join(whole, "key", "full").select("key", F.coalesce("whole", "marked").alias("spans")))


def _context_bytes(texts: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """(a, ctx, contexts, bytes) of the asked representatives."""
    lists = asked.groupBy("key").agg(F.collect_list(F.struct("a", "ctx", "contexts", "lo", "hi")).alias("asked"))
    schema = pa.schema([("a", pa.int64()), ("ctx", pa.int64()), ("contexts", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, rows in zip(batch.column(0), batch.column(1)):
                data = text.as_buffer()
                for r in rows.as_py():
                    out.append({"a": r["a"], "ctx": r["ctx"], "contexts": r["contexts"], "bytes": data[r["lo"] : r["hi"] + length].to_pybytes()})
            yield pa.RecordBatch.from_pylist(out, schema)

    # Merged whatever the sizes: texts go where their key goes, and no list is sent to all tasks.
    joined = texts.join(staged(lists).hint("merge"), "key").select("text", "asked")
    return joined.mapInArrow(run, "a bigint, ctx bigint, contexts bigint, bytes binary").dropDuplicates(["a", "ctx"])


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row; kept are the bytes outside the removed spans."""
    found = spans(docs, text_col, **bounds)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    joined = rows.join(found.hint("merge"), "key", "left").select("id", "text", "spans")
    kinds = "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, size = [], []
            for text, cut in zip(batch.column(1), batch.column(2)):
                data = bytes(text.as_buffer()) if text.is_valid else b""
                size.append(len(data))
                if cut.is_valid:
                    at, parts = 0, []
                    for s in cut.as_py():
                        parts.append(data[at : s["start"]])
                        at = s["end"]
                    data = b"".join([*parts, data[at:]])
                kept.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), batch.column(2), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"]
            )

    return joined.withColumn("id", F.col("id").cast("long")).mapInArrow(run, kinds).withColumnRenamed("id", id_col)


def digest(removed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    cut = F.coalesce("spans", none)
    return removed.select(
        id_col,
        "n_bytes",
        F.aggregate(cut, F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"]).alias("n_removed"),
        F.size(cut).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

