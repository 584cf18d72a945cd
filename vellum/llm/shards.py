"""Shards of at most a number of bytes, by extendible hashing.

The directory is indexed by the first bits of a row's hash. All rows share one bucket; a bucket with
more bytes than the limit is split on its next bit, and only such buckets are, until every shard fits.
Bytes are summed once for the leaves of a directory some bits deeper than the shards are expected to
be, and rolled up bit by bit; leaves that are still too large go on alone with more bits.

Cases: null texts and ids are read as empty. Rows repeated with id and text cannot be told apart by
bits; they are cut into pieces that fit, evenly. A single row larger than the limit is a shard of its
own. An empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import staged
from vellum.operators.skew import running_sum

LIMIT = 4 << 20
BITS = 60
DEEPER = 3


def row_hash(id_col: str, text_col: str) -> Column:
    """The first 60 bits of the md5 of id and text."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text_col, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def label(depth: Column, prefix: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, F.lit("0")))


def _leaf(depth: int) -> Column:
    return F.shiftrightunsigned("h", BITS - depth)


def assign(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, n_bytes, depth, shard, pieces) of every row; shard: the hash bits, and ``/n`` for a piece.

    ``n_bytes`` are the bytes of the text.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), row_hash(id_col, text_col).alias("h"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    )
    # Repeated rows come together on the map side and part again at the end.
    still = staged(rows.groupBy("id", "h", "n_bytes").agg(F.count("*").alias("copies")))
    done, low, depth = [], 0, 0
    while True:
        total = still.agg(F.sum(F.col("n_bytes") * F.col("copies"))).first()[0] or 0
        expected = DEEPER + math.ceil(math.log2(max(total / limit, 1))) if not low else 8
        depth = min(BITS, low + expected)
        leaves = staged(still.groupBy(_leaf(depth).alias("leaf")).agg(F.sum(F.col("n_bytes") * F.col("copies")).alias("bytes")))
        up = leaves.select("leaf", "bytes", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth"))
        up = up.withColumn("prefix", F.expr(f"shiftrightunsigned(leaf, {depth} - depth)"))
        fits = staged(up.groupBy("depth", "prefix").agg(F.sum("bytes").alias("all")).filter(F.col("all") <= limit))
        # The first depth that fits: the bucket above it was split.
        found = staged(up.join(fits, ["depth", "prefix"]).groupBy("leaf").agg(F.min("depth").alias("depth")))
        keyed = still.withColumn("leaf", _leaf(depth))
        done.append(
            keyed.join(found, "leaf").withColumn("prefix", F.expr(f"shiftrightunsigned(leaf, {depth} - depth)")).drop("leaf").withColumn("pieces", F.lit(1))
        )
        still = staged(keyed.join(found, "leaf", "left_anti").drop("leaf"))
        if depth == BITS or still.isEmpty():
            break
        low = depth + 1
    each = F.greatest(F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))), F.lit(1))
    pieces = F.greatest(F.ceil(F.col("copies") / each), F.lit(1)).cast("int")
    done.append(still.withColumn("depth", F.lit(BITS)).withColumn("prefix", F.col("h")).withColumn("pieces", pieces))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    piece = F.when(F.col("pieces") > 1, F.concat(F.lit("/"), ((F.col("copy") - 1) % F.col("pieces")).cast("string")))
    shard = F.concat(label(F.col("depth"), F.col("prefix")), F.coalesce(piece, F.lit("")))
    return out.select(F.col("id").alias(id_col), "h", "n_bytes", F.col("depth").cast("int").alias("depth"), shard.alias("shard"), "pieces")


def write_shards(docs: DataFrame, folder: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """All columns of ``docs`` as Parquet, one folder per shard (``_shard=...``).

    Where rows repeated with id and text need several shards, equal rows are counted, numbered in the order of a
    hash of all columns, and dealt to the shards in turn: as even as ``assign``, and the same
    whenever a task or the whole is run again. Columns must be of types that can be grouped.
    """
    own = assign(docs, limit, id_col, text_col)
    base = F.substring_index("shard", "/", 1)
    places = staged(own.groupBy(F.col("h").alias("_h")).agg(F.min(base).alias("_base"), F.max("pieces").alias("_pieces")))
    names = docs.columns
    rows = docs.withColumn("_h", row_hash(id_col, text_col)).join(places, "_h")
    name = F.concat(F.lit("s"), F.col("_base"))
    single = rows.filter("_pieces = 1").select(*names, name.alias("_shard"))
    order = F.pmod(F.xxhash64(*names), F.lit(1 << 40))
    equal = rows.filter("_pieces > 1").groupBy(*names, "_h", "_base", "_pieces").agg(F.count(F.lit(1)).alias("_copies"))
    numbered = running_sum(staged(equal.withColumn("_order", order)), ["_h"], "_order", F.col("_copies"), "_end")
    each = numbered.withColumn("_n", F.explode(F.sequence(F.col("_end") - F.col("_copies"), F.col("_end") - 1)))
    many = each.select(*names, F.concat(name, F.lit("-"), (F.col("_n") % F.col("_pieces")).cast("string")).alias("_shard"))
    single.unionByName(many).repartition("_shard").write.partitionBy("_shard").parquet(folder)
