"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation's rows are edited at least cost until its role initials read ``(s?(ua)+)?``: Keep costs 0,
Rerole to user or assistant 3, Delete 4, Insert of a user or assistant row without text 3; a truncated row
that stays adds 3. Blank rows and repeats of an earlier (role, text) must be deleted. Among the cheapest
edits the one with the ASCII-least audit (the edits' initials in order) is taken.

Four states say what may follow: nothing yet, after system, after user, after assistant. A cost vector
holds the least cost of the rest from each state. Rows are sorted by conversation and order into ranges, and cut
into chunks of ``CHUNK`` rows that are free to stay. Every chunk first runs backward from a speculative
vector (the last one of a conversation from the true one). Fix-up passes run chunks again from the vector their
right neighbour has found, until it differs from the one used by a constant only; such a chunk's decisions
do not change, and inside a chunk the run stops at the first row where old and new vector differ by a
constant. A conversation's cost is the first chunk's cost and the constants in between. The audit is
traced forward along the stitched costs: each chunk tells which state it leaves from each state it may
be entered in, these maps are joined in doubling steps, and then every chunk writes its edits.

Must-delete rows change no decision; they add 4 and a ``D`` and do not count for the cuts, so that a
chunk without a free row exists only where a whole sorted range holds none. Identical rows travel as one row
with a count. Passes grow with the number of neighbouring chunks whose vectors never meet, such as long runs
of rows that all have other roles; conversations of one chunk need none.

Order: turn (nulls first), then role and text; copies are adjacent. Cases: a null role or text is one
blank; a null conversation id is an id of its own. A role's initial is its first character; rows with other initials
than s, u, a, or without one, cannot be kept as they are. Empty and very long texts are read whole. An
empty table gives no rows; a conversation without rows zeros, an empty audit and the hash of an empty text.
Other columns are not read. The audit and the hash of a conversation are single values by contract;
the hash is computed in a stream, so that no task holds a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import staged
from vellum.operators.skew import lookup_join

CHUNK = 1024
#: Values of one padded array of chunks that run side by side.
LANES = 4_000_000
SPACE = r"\x20\x09-\x0D"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
FAR = 1 << 20
#: Next state by what a state expects: a user from start, system and assistant, an assistant from user.
NEXT = np.array([2, 2, 3, 2])
#: State after keeping a row, by state and initial (other, s, u, a); -1: not legal.
KEPT = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
END = np.array([0, 6, 3, 0])
ROLES = np.array(["user", "user", "assistant", "user"], object)


# --- damage --------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after dropping, emptying, cutting, repeating and relabelling rows."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


# --- faults and chunks ----------------------------------------------------------------------------


def _conv_key(name: str = "conv_id") -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("v"), F.col(name).cast("string")), F.lit("n"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``copies`` and flags: blank, repeated (an earlier turn has them), cut, initial."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = rows.select(_conv_key().alias("ck"), "conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"))
    distinct = own.groupBy("ck", "conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    flagged = staged(
        distinct.withColumns(
            {
                "blank": ~F.col("text").rlike(f"[^{SPACE}]"),
                "cut": ~F.col("text").rlike(f"[.!?][{SPACE}]*\\z"),
                "initial": F.coalesce(F.expr("array_position(array('s', 'u', 'a'), substring(role, 1, 1))"), F.lit(0)).cast("int"),
                "key": F.unhex(F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"))),
                "at": F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")),
            }
        )
    )
    first = flagged.filter("not blank").groupBy("ck", "key").agg(F.min("at").alias("first"))
    light = flagged.filter("not blank").select("ck", "key", "turn", "at")
    later = lookup_join(light, first, ["ck", "key"], ["turn"]).filter("at > first").select(
        F.col("ck").alias("_ck"), F.col("key").alias("_key"), F.col("turn").alias("_turn")
    )
    match = (F.col("ck") == F.col("_ck")) & (F.col("key") == F.col("_key")) & F.col("turn").eqNullSafe(F.col("_turn"))
    return flagged.join(later, match, "left").withColumn("repeated", F.col("_ck").isNotNull()).drop("_ck", "_key", "_turn", "key", "at")


def chunked(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows in order with ``g`` (number of the chunk over all ranges), ``pos`` in it and ``forced``."""
    turn = F.asc_nulls_first("turn")
    ranges = rows.repartitionByRange("ck", turn, "role", "text").sortWithinPartitions("ck", turn, "role", "text")
    names = ["ck", "forced", *[c for c in rows.columns if c != "ck"]]
    shaped = ranges.withColumn("forced", F.col("blank") | F.col("repeated")).select(*names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, k, free, pos = None, -1, 0, 0
        for batch in batches:
            chunks, places = [], []
            for ck, forced in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ck != last or (not forced and free == chunk):
                    last, k, free, pos = ck, k + 1, 0, 0
                free += not forced
                chunks.append(k)
                places.append(pos)
                pos += 1
            own = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(chunks, pa.int64()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, "part", "chunk", "pos"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shaped.schema)
    numbered = staged(shaped.mapInArrow(number, f"{fields}, part int, chunk long, pos long"))
    counts = sorted((r["part"], r["n"]) for r in numbered.groupBy("part").agg(F.max("chunk").alias("n")).collect())
    offsets, before = [], 0
    for part, n in counts:  # one row per sorted range
        offsets.append((part, before))
        before += n + 1
    known = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    return numbered.join(F.broadcast(known), "part").withColumn("g", F.col("before") + F.col("chunk")).drop("part", "chunk", "before")


def chunk_table(rows: DataFrame) -> DataFrame:
    """One row per chunk: its codes in order, and the neighbours' places."""
    code = (F.col("initial") + 4 * F.col("cut").cast("int") + 8 * F.col("forced").cast("int")).alias("code")
    packed = F.sort_array(F.collect_list(F.struct("pos", code, "copies")))
    chunks = rows.groupBy("ck", "g").agg(packed.alias("p")).select("ck", "g", F.col("p.code").alias("codes"), F.col("p.copies").alias("copies"))
    spans = chunks.groupBy("ck").agg(F.min("g").alias("first"), F.max("g").alias("last"))
    return chunks.join(spans, "ck")


# --- the vectors -----------------------------------------------------------------------------------


def lanes(codes: list, copies: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunk numbers, codes, copies) of chunks of like length, padded with -1 in front."""
    size = np.array([len(c) for c in codes])
    order = np.argsort(size, kind="stable")
    first = 0
    while first < len(order):
        last = first + 1
        while last < len(order) and size[order[last]] * (last + 1 - first) <= LANES and size[order[last]] <= 2 * size[order[first]] + 8:
            last += 1
        own = order[first:last]
        width = int(size[own].max())
        code, count = np.full((len(own), width), -1, np.int64), np.ones((len(own), width), np.int64)
        for i, n in enumerate(own):
            code[i, width - size[n] :], count[i, width - size[n] :] = codes[n], copies[n]
        yield own, code, count
        first = last


def _opened(v: np.ndarray) -> np.ndarray:
    """Costs where rows may be inserted first: at most two in a row are ever worth it."""
    once = np.minimum(v, INSERT + v[:, NEXT])
    return np.minimum(once, INSERT + once[:, NEXT])


def _choices(after: np.ndarray, code: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and reroling a row in each state, given the costs after it."""
    rest = after + DELETE * (copies - 1)[:, None]
    initial, cut, forced = code & 3, (code >> 2) & 1, code >> 3
    bar = (FAR * forced + CUT * cut)[:, None]
    to = KEPT[:, initial].T
    kept = np.where(to >= 0, np.take_along_axis(rest, np.maximum(to, 0), 1), FAR) + KEEP + bar
    return DELETE + rest, kept, REROLE + rest[:, NEXT] + bar


def step(after: np.ndarray, code: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Cost vectors before a row from those after it; padding leaves them."""
    found = _opened(np.minimum.reduce(_choices(after, np.maximum(code, 0), copies)))
    return np.where((code < 0)[:, None], after, found)


def parallel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two vectors differ by a constant only."""
    gap = a - b
    return (gap == gap[:, :1]).all(axis=1)


def backward(code: np.ndarray, copies: np.ndarray, right: np.ndarray) -> np.ndarray:
    v = right
    for i in range(code.shape[1] - 1, -1, -1):
        v = step(v, code[:, i], copies[:, i])
    return v


def fix_up(code: np.ndarray, copies: np.ndarray, old: np.ndarray, new: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The left vectors for a new right one, from those of the old one: stops where both are parallel."""
    out, open_ = left.copy(), np.arange(len(code))
    for i in range(code.shape[1] - 1, -1, -1):
        met = parallel(old, new)
        out[open_[met]] += (new - old)[met, :1]
        open_, old, new = open_[~met], old[~met], new[~met]
        if not len(open_):
            return out
        both = [step(x, code[open_, i], copies[open_, i]) for x in (old, new)]
        old, new = both
    out[open_] = new
    return out


def trace(code: np.ndarray, copies: np.ndarray, right: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple:
    """(edits, inserts before, state before the inserts) per row, final state, trailing inserts.

    Edits are ``D``, ``K``, ``R`` or a blank for padding.
    """
    n, width = code.shape
    after = np.empty((width + 1, n, 4), np.int64)
    after[width] = right
    for i in range(width - 1, -1, -1):
        after[i] = step(after[i + 1], code[:, i], copies[:, i])
    edits, inserts, entered = np.full((n, width), " ", "U1"), np.zeros((n, width), np.int8), np.zeros((n, width), np.int8)
    row = np.arange(n)
    for i in range(width):
        real = code[:, i] >= 0
        delete, keep, rerole = _choices(after[i + 1], np.maximum(code[:, i], 0), copies[:, i])
        entered[:, i] = state
        for _ in range(2):
            now = after[i][row, state]
            insert = real & (delete[row, state] != now) & (INSERT + after[i][row, NEXT[state]] == now)
            inserts[:, i] += insert
            state = np.where(insert, NEXT[state], state)
        now = after[i][row, state]
        gone, stays = delete[row, state] == now, keep[row, state] == now
        edits[:, i] = np.where(real, np.where(gone, "D", np.where(stays, "K", "R")), " ")
        to = np.where(stays, KEPT[state, np.maximum(code[:, i], 0) & 3], NEXT[state])
        state = np.where(real & ~gone, to, state)
    trailing = np.where(last, np.array([0, 2, 1, 0])[state], 0)
    return edits, inserts, entered, state, trailing


# --- passes ----------------------------------------------------------------------------------------

_VECTORS = "ck string, g long, codes array<int>, copies array<long>, first long, last long, `right` array<long>, `left` array<long>"


def _stacked(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.int64).reshape(len(column), 4)


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        last = np.array(c["g"].to_pylist(), np.int64) == np.array(c["last"].to_pylist(), np.int64)
        right = np.where(last[:, None], END, 0)
        left = np.zeros_like(right)
        for own, code, copies in lanes(c["codes"].to_pylist(), c["copies"].to_pylist()):
            left[own] = backward(code, copies, right[own])
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(right.tolist(), kind), pa.array(left.tolist(), kind)], [*batch.schema.names, "right", "left"])


def _fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with ``found``, the vector of the right neighbour; unchanged ones keep theirs."""
    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        if not batch.num_rows:
            continue
        right, left, found = (_stacked(c[n]) for n in ("right", "left", "found"))
        moved = np.flatnonzero(~parallel(right, found))
        codes, copies = c["codes"].to_pylist(), c["copies"].to_pylist()
        for own, code, count in lanes([codes[i] for i in moved], [copies[i] for i in moved]):
            at = moved[own]
            left[at] = fix_up(code, count, right[at], found[at], left[at])
            right[at] = found[at]
        kind = pa.list_(pa.int64())
        names = [n for n in batch.schema.names if n not in ("right", "left", "found")]
        changed = np.zeros(batch.num_rows, bool)
        changed[moved] = True
        yield pa.RecordBatch.from_arrays(
            [*(c[n] for n in names), pa.array(right.tolist(), kind), pa.array(left.tolist(), kind), pa.array(changed)],
            [*names, "right", "left", "changed"],
        )


def vectors(chunks: DataFrame) -> tuple[DataFrame, int]:
    """Chunks with vectors that agree with their neighbours up to constants, and the number of fix-up passes."""
    found = staged(chunks.select("ck", "g", "codes", "copies", "first", "last").mapInArrow(_speculate, _VECTORS))
    alone, many = found.filter("first = last"), found.filter("first < last")
    passes = 0
    if many.isEmpty():
        return found, passes
    while True:
        neighbour = many.select((F.col("g") - 1).alias("g"), F.col("ck").alias("_ck"), F.col("left").alias("found"))
        inner = many.join(neighbour, "g", "left").withColumn("found", F.when(F.col("_ck") == F.col("ck"), F.col("found")).otherwise(F.col("right")))
        fields = inner.select("ck", "g", "codes", "copies", "first", "last", "right", "left", "found")
        done = staged(fields.mapInArrow(_fix, f"{_VECTORS}, changed boolean"))
        passes += 1
        many = done.drop("changed")
        if done.filter("changed").isEmpty():
            return alone.unionByName(many), passes


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, first, start, map): the state each chunk leaves from each state it may be entered in."""
    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        right = _stacked(c["right"])
        out = np.zeros((batch.num_rows, 4), np.int64)
        for own, code, copies in lanes(c["codes"].to_pylist(), c["copies"].to_pylist()):
            for s in range(4):
                out[own, s] = trace(code, copies, right[own], np.full(len(own), s), np.zeros(len(own), bool))[3]
        yield pa.RecordBatch.from_arrays([c["g"], c["first"], c["g"], pa.array(out.tolist(), pa.list_(pa.int64()))], ["g", "first", "start", "map"])


def entries(found: DataFrame) -> DataFrame:
    """(g, state) in which each chunk is entered. Maps over spans of chunks are joined until they start
    at the conversation's first chunk or lead to one state; spans double with every step."""
    start = found.filter("g = first").select("g", F.lit(0).cast("long").alias("state"))
    many = found.filter("first < last")
    if many.isEmpty():
        return start
    spans = staged(many.select("g", "first", "right", "codes", "copies").mapInArrow(_exits, "g long, first long, start long, map array<long>"))
    is_open = (F.col("start") > F.col("first")) & (F.size(F.array_distinct("map")) > 1)
    while not spans.filter(is_open).isEmpty():
        before = spans.select((F.col("g") + 1).alias("start"), F.col("start").alias("_start"), F.col("map").alias("_map"))
        longer = spans.filter(is_open).join(before, "start").select(
            "g", "first", F.col("_start").alias("start"), F.expr("transform(_map, s -> map[int(s)])").alias("map")
        )
        spans = staged(spans.filter(~is_open).unionByName(longer))
    left = spans.select((F.col("g") + 1).alias("g"), F.col("first").alias("_first"), F.expr("map[0]").alias("state"))
    inner = many.filter("g > first").select("g", "first").join(left, "g").filter("first = _first")
    return start.unionByName(inner.select("g", "state"))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        right, state = _stacked(c["right"]), np.array(c["state"].to_pylist(), np.int64)
        last = np.array(c["g"].to_pylist(), np.int64) == np.array(c["last"].to_pylist(), np.int64)
        codes, counts = c["codes"].to_pylist(), c["copies"].to_pylist()
        rows: list = [None] * batch.num_rows
        for own, code, copies in lanes(codes, counts):
            edits, inserts, entered, end, trailing = trace(code, copies, right[own], state[own], last[own])
            for i, n in enumerate(own):
                at = slice(code.shape[1] - len(codes[n]), None)
                audit = "".join("I" * k + e + "D" * (m - 1) for k, e, m in zip(inserts[i, at].tolist(), edits[i, at].tolist(), counts[n]))
                rows[n] = ("".join(edits[i, at]), inserts[i, at].tolist(), entered[i, at].tolist(), audit + "I" * int(trailing[i]), int(trailing[i]), int(end[i]))
        kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string(), pa.int32(), pa.int32()]
        names = ["edits", "inserts", "states", "audit", "trailing", "end"]
        yield pa.RecordBatch.from_arrays([c["ck"], c["g"], *(pa.array([r[k] for r in rows], kinds[k]) for k in range(6))], ["ck", "g", *names])


class Repair:
    """``rows`` with flags and places, ``chunks`` with vectors, ``edits`` per chunk, and the ``passes`` made."""

    def __init__(self, damaged: DataFrame, chunk: int = CHUNK):
        self.rows = chunked(with_faults(damaged), chunk)
        self.chunks, self.passes = vectors(staged(chunk_table(self.rows)))
        fields = "ck string, g long, edits string, inserts array<int>, states array<int>, audit string, trailing int, `end` int"
        work = self.chunks.join(entries(self.chunks), "g").select("ck", "g", "last", "codes", "copies", "right", "state")
        self.edits = staged(work.mapInArrow(_edits, fields))

    def edited(self) -> DataFrame:
        """Every distinct row with its ``edit``, the ``role`` it gets, and the roles inserted before and after it."""
        other = lambda s: F.when(F.col(s) == 2, "assistant").otherwise("user")
        second = F.when(F.col("state") == 2, "user").otherwise("assistant")
        place = F.col("pos").cast("int") + 1
        rows = self.rows.join(self.edits.drop("ck"), "g").withColumns(
            {
                "edit": F.substring("edits", place, F.lit(1)),
                "state": F.element_at("states", place),
                "k": F.element_at("inserts", place),
                "is_end": F.col("pos") == F.size("states") - 1,
            }
        )
        expects = F.when(F.col("k") % 2 == 0, F.col("state") == 2).otherwise(F.col("state") != 2)
        return rows.select(
            "ck", "conv_id", "turn", "g", "pos", "copies", "text", "edit",
            F.when(F.col("edit") == "R", F.when(expects, "assistant").otherwise("user")).otherwise(F.col("role")).alias("role"),
            F.slice(F.array(other("state"), second), 1, F.col("k")).alias("before"),
            F.when(F.col("is_end"), F.slice(F.array(other("end"), F.when(F.col("end") == 2, "user").otherwise("assistant")), 1, F.col("trailing")))
            .otherwise(F.array().cast("array<string>")).alias("after"),
        )

    def repaired(self) -> DataFrame:
        """(conv_id, g, pos, part, role, text) of the rows that stand after the edits, in that order."""
        whole = F.when(F.col("edit") != "D", F.array(F.struct("role", "text"))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
        empty = lambda c: F.transform(c, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
        parts = F.concat(empty("before"), whole, empty("after"))
        return self.edited().select("ck", "conv_id", "g", "pos", F.posexplode(parts).alias("part", "r")).select(
            "ck", "conv_id", "g", "pos", "part", "r.role", "r.text"
        )

    def faults(self) -> DataFrame:
        """(ck, gaps, blank, duplicate, truncated) by conversation."""
        known = F.countDistinct("turn")
        gap = F.coalesce(F.max("turn") - F.min("turn") + 1 - known, F.lit(0)).cast("long")
        count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
        return self.rows.groupBy("ck").agg(
            gap.alias("gaps"),
            count(F.when(F.col("blank"), F.col("copies"))).alias("blank"),
            count(F.when(~F.col("blank"), F.col("copies") - (~F.col("repeated")).cast("int"))).alias("duplicate"),
            count((F.col("cut") & ~F.col("forced")).cast("long")).alias("truncated"),
        )

    def totals(self) -> DataFrame:
        """(ck, illegal, cost, audit) by conversation, put together from its chunks."""
        nothing = F.array().cast("array<int>")
        near = self.chunks.select(
            (F.col("g") - 1).alias("g"), F.col("ck").alias("_ck"), F.col("left").alias("found"), (F.col("codes")[0].bitwiseAND(3)).alias("_next")
        )
        legal = lambda a, b: ((a == 1) & (b == 2)) | ((a == 2) & (b == 3)) | ((a == 3) & (b == 2))
        low = F.transform("codes", lambda x: x.bitwiseAND(3))
        pairs = F.zip_with(F.slice("i", 1, F.size("i") - 1), F.slice("i", 2, F.size("i") - 1), lambda a, b: F.when(legal(a, b), 0).otherwise(1))
        inside = F.aggregate(F.when(F.size("i") > 1, pairs).otherwise(nothing), F.lit(0).cast("long"), lambda s, x: s + x)
        more = F.aggregate("copies", F.lit(0).cast("long"), lambda s, x: s + x - 1)
        joined = self.chunks.withColumn("i", low).join(near, "g", "left").withColumn("same", F.coalesce(F.col("_ck") == F.col("ck"), F.lit(False)))
        edge = F.when(F.col("same") & ~legal(F.element_at("i", -1), F.col("_next")), 1).otherwise(0)
        cost = F.when(F.col("g") == F.col("first"), F.col("left")[0]).otherwise(0) + F.when(F.col("same"), F.col("found")[0] - F.col("right")[0]).otherwise(0)
        sums = joined.groupBy("ck").agg(F.sum(inside + more + edge).alias("illegal"), F.sum(cost).alias("cost"))
        parts = F.sort_array(F.collect_list(F.struct("g", "audit")))
        audits = self.edits.groupBy("ck").agg(F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
        return sums.join(audits, "ck")

    def hashes(self) -> DataFrame:
        """(ck, repaired_sha256) of conversations with repaired rows, read as a stream in their order."""
        rows = self.repaired().select("ck", "g", "pos", "part", "role", "text")
        ordered = rows.repartition("ck").sortWithinPartitions("ck", "g", "pos", "part").select("ck", "role", "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, state = None, None
            for batch in batches:
                done = []
                for ck, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    if ck != now:
                        if state:
                            done.append((now, state.hexdigest()))
                        now, state, join = ck, hashlib.sha256(), ""
                    state.update(f"{join}{role}:{text}".encode())
                    join = "\n"
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], ["ck", "repaired_sha256"])
            if state:
                yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["ck", "repaired_sha256"])

        return ordered.mapInArrow(run, "ck string, repaired_sha256 string")


def digest(conversations: DataFrame, repair: Repair) -> DataFrame:
    """One row for every original conversation id."""
    ids = conversations.select("conv_id").distinct().withColumn("ck", _conv_key())
    found = ids.join(repair.faults(), "ck", "left").join(repair.totals(), "ck", "left").join(repair.hashes(), "ck", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return found.select(
        "conv_id",
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
