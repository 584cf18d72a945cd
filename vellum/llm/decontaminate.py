"""Benchmark decontamination through a hash set of normalised n-grams.

Words are read after lower-casing A-Z. A window is ``size`` consecutive words of a benchmark item; a
shorter item with at least one word is one window. Document windows are hashed inside the scan,
looked up in the set of benchmark windows and compared word by word, so a hash never decides alone.

The window set is broadcast only while it takes at most ``BROADCAST_BYTES`` (counted). Beyond that the
windows of the documents are shuffled by their hash, as places only; the few that are found come back to
their documents, where the words are compared. Both ways give the same rows.

Cases: null texts have no words. Repeated rows and null ids give one output row each. Items without
words, and null item ids, are never listed; windows of an item with a null id still count as hits.
Empty benchmark: nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import ascii_lower, staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SIZE = 10
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hash_at(size: int) -> Column:
    """Hash of the ``size`` words from place ``i`` of ``words``; null where they do not fit."""
    parts = [F.get("words", F.col("i") + k) for k in range(size)]
    return F.when(
        (F.col("i") >= 0) & (F.col("i") + size <= F.size("words")), F.xxhash64(F.lit(size).cast("int"), *parts)
    )


def placed_windows(benchmark: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, size, h, gram): every window of every item."""
    items = benchmark.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("words")).filter(
        F.size("words") > 0
    )
    at = items.select(
        "item",
        "words",
        F.least(F.size("words"), F.lit(size)).alias("size"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))).alias("i"),
    )
    hashed = F.lit(None).cast("long")
    for n in range(1, size + 1):
        hashed = F.when(F.col("size") == n, _hash_at(n)).otherwise(hashed)
    return at.select("item", "size", hashed.alias("h"), F.slice("words", F.col("i") + 1, F.col("size")).alias("gram"))


def windows(benchmark: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(h, size, gram, items): the distinct windows with the ids of their items."""
    return placed_windows(benchmark, size, id_col, text_col).groupBy("h", "size", "gram").agg(F.collect_set("item").alias("items"))


def _places(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """The rows with every place ``i`` from -1 and the hash ``h`` of the ``n`` words there."""
    at = rows.select("*", F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("i"))
    if len(sizes) == 1:
        return at.select("*", F.lit(sizes[0]).alias("n"), _hash_at(sizes[0]).alias("h"))
    pairs = F.array(*(F.struct(F.lit(n).alias("n"), _hash_at(n).alias("h")) for n in sizes))
    return at.select(*rows.columns, "i", F.inline(pairs))


def _per_row_shuffled(rows: DataFrame, placed: DataFrame, sizes: list[int]) -> DataFrame:
    """(id, row, row2, n_words, copies, found, items) with the windows shuffled by hash, without their words."""
    placed = staged(placed.distinct())
    grams = placed.select("h", F.col("size").alias("n"), "gram").distinct()
    at = _places(rows, sizes).select("row", "row2", "i", "n", "h").filter("h is not null")
    hits = at.join(placed.select("h", F.col("size").alias("n")).distinct(), ["h", "n"]).join(grams, ["h", "n"])
    # The windows of one document that have a benchmark window's hash.
    asked = staged(hits.groupBy("row", "row2").agg(F.collect_set(F.struct("i", "n", "h", "gram")).alias("asked")))
    own = rows.select("row", "row2", "words").join(asked, ["row", "row2"])
    equal = F.filter("asked", lambda c: F.slice("words", c["i"] + 1, c["n"]) == c["gram"])
    sure = staged(own.select("row", "row2", equal.alias("sure")).filter(F.size("sure") > 0).dropDuplicates(["row", "row2"]))
    spans = F.array_sort(F.array_distinct(F.transform("sure", lambda c: F.struct(c["i"].alias("i"), (c["i"] + c["n"]).alias("end")))))
    listed = sure.select("row", "row2", F.explode("sure").alias("c")).select("row", "row2", "c.h", F.col("c.n").alias("size"), "c.gram")
    items = listed.join(placed, ["h", "size", "gram"]).groupBy("row", "row2").agg(F.collect_set("item").alias("items"))
    counted = rows.groupBy("id", "row", "row2").agg(F.max(F.size("words")).alias("n_words"), F.count(F.lit(1)).alias("copies"))
    joined = counted.join(sure.select("row", "row2", spans.alias("found")), ["row", "row2"], "left").join(items, ["row", "row2"], "left")
    kind = placed.schema["item"].dataType.simpleString()
    return joined.withColumns(
        {"found": F.coalesce("found", F.array().cast("array<struct<i:int,end:int>>")), "items": F.coalesce("items", F.array().cast(f"array<{kind}>"))}
    )


def _per_row(rows: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """The same with the window set in every task: the text is read once, and only found windows leave it.

    Place -1 stands for the document itself, so that documents without hits keep a row.
    """
    at = _places(rows, sizes)
    # The words are compared as two inequalities: an equality would become a join key and be
    # computed for every window, not only for those whose hash is found.
    own = F.slice(at["words"], at["i"] + 1, at["n"])
    same = (at["h"] == grams["h"]) & (own >= grams["gram"]) & (own <= grams["gram"])
    seen = at.join(F.broadcast(grams), same, "left").select(
        "id",
        "row",
        "row2",
        F.size("words").alias("n_words"),
        F.when(F.col("i") < 0, 1).alias("self"),
        F.when(F.col("gram").isNotNull(), F.struct("i", (F.col("i") + F.col("n")).alias("end"))).alias("span"),
        "items",
    )
    per_row = (
        seen.filter("self = 1 or span is not null")
        .groupBy("id", "row", "row2")
        .agg(
            F.max("n_words").alias("n_words"),
            F.count("self").alias("copies"),
            F.array_sort(F.collect_set("span")).alias("found"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
    )
    # Each size of the set gave one "self" row.
    return per_row.select("id", "row", "row2", "n_words", "found", "items", (F.col("copies") / len(sizes)).cast("int").alias("copies"))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SIZE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, row, n_words, spans, items) for every row; spans are merged [start, end) word places.

    ``row`` is a hash of id and text. Other columns of the inputs are left out.
    """
    placed = placed_windows(benchmark, size, item_col, item_text_col)
    each = F.octet_length(F.array_join("gram", " ")) + 64
    stats = placed.groupBy("size").agg(F.sum(each).alias("bytes")).collect()  # at most ``size`` rows
    sizes = sorted((r["size"] for r in stats), reverse=True) or [size]
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(id_col, text_col).alias("row"),
        F.xxhash64(F.lit("second"), text_col, id_col).alias("row2"),
        words(F.col(text_col)).alias("words"),
    )
    if sum(r["bytes"] for r in stats) <= BROADCAST_BYTES:
        per_row = _per_row(rows, windows(benchmark, size, item_col, item_text_col), sizes)
    else:
        per_row = _per_row_shuffled(rows, placed, sizes)
    state = F.array().cast("array<struct<start:int,end:int>>")
    merged = F.aggregate(
        "found",
        state,
        lambda acc, x: F.when(
            F.size(acc) == 0, F.array(F.struct(x["i"].alias("start"), x["end"].alias("end")))
        ).when(
            x["i"] <= F.get(acc, F.size(acc) - 1)["end"],
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.get(acc, F.size(acc) - 1)["start"].alias("start"),
                        F.greatest(F.get(acc, F.size(acc) - 1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(x["i"].alias("start"), x["end"].alias("end"))))),
    )
    # Rows repeated with id and text came together above; they part again here.
    spans = per_row.select("id", "row", "n_words", merged.alias("spans"), "items", F.col("copies").cast("int").alias("copies"))
    return spans.select(
        F.col("id").alias(id_col), "row", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    ).drop("_copy")


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    hit = F.aggregate("spans", F.lit(0), lambda acc, s: acc + s["end"] - s["start"]).cast("long")
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return scanned.select(
        id_col,
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **names) -> DataFrame:
    """The documents without benchmark passages, with all their columns.

    remove: ``documents`` leaves out every document with a hit; ``spans`` keeps it and takes out the
    hit words with the separators between them (numbers of characters are left as they were).
    """
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    mark = "_contaminated_row"
    found = scan(docs, benchmark, **names).filter(F.size("spans") > 0).select(F.col("row").alias(mark), "spans").distinct()
    keyed = docs.withColumn(mark, F.xxhash64(id_col, text_col))
    if remove == "documents":
        return keyed.join(found.select(mark), mark, "left_anti").select(*docs.columns)
    cased = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    joined = keyed.join(found.withColumnRenamed("spans", "_contaminated_spans"), mark, "left")
    own = F.regexp_extract_all(text_col, F.lit(cased), F.lit(0))
    gaps = F.split(text_col, cased, -1)
    joined = joined.withColumn("_own", own).withColumn("_gaps", gaps)
    places = F.flatten(
        F.transform("_contaminated_spans", lambda s: F.sequence(s["start"], s["end"] - 1))
    )
    joined = joined.withColumn("_places", places)
    kept = F.zip_with(
        F.transform("_gaps", lambda g, i: F.struct(g.alias("g"), i.alias("i"))),
        "_own",
        lambda g, w: F.concat(
            # The separator before a hit word goes if the word before it is hit too.
            F.when(
                F.array_contains("_places", g["i"]) & F.array_contains("_places", g["i"] - 1), F.lit("")
            ).otherwise(g["g"]),
            F.when(w.isNull() | F.array_contains("_places", g["i"]), F.lit("")).otherwise(w),
        ),
    )
    text = F.when(F.col("_contaminated_spans").isNull(), F.col(text_col)).otherwise(F.array_join(kept, ""))
    return joined.withColumn(text_col, text).select(*docs.columns)
