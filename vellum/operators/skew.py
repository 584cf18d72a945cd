"""Joins, ranks and running values that hold when one key owns a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_KEYS, TRACKED = 4096, 16_384
ROWS_PER_PIECE = 1_000_000
CHUNK_ROWS, FAN = 100_000, 10_000_000


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row per key.  Spark keeps one row per key and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def first_n_by(df: DataFrame, keys: list[str], order: list, n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows per key, pruned to ``n`` per key and task before the shuffle."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    kept = df.withColumn("_rank", number).filter(F.col("_rank") <= n)
    return kept.withColumnRenamed("_rank", rank) if rank else kept.drop("_rank")


def key_counts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, combined on the map side."""
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _key_hash(keys: list[str]) -> Column:
    """One hash for a key on both sides, also where a number is INT on one and LONG on the other."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def heavy_keys(facts: DataFrame, keys: list[str], rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Hashes ``_hot`` of at most ``HOT_KEYS`` keys with more rows than one piece, and their pieces.

    A frequent-items sketch of bounded size finds them in one pass over the key columns, without a
    shuffle by key.  It names every key with more than about ``4 / TRACKED`` of the rows.
    """
    top = facts.select(_key_hash(keys).alias("_hot")).agg(F.expr(f"approx_top_k(_hot, {HOT_KEYS}, {TRACKED})").alias("_top"))
    rows = top.select(F.explode("_top").alias("_t")).select(F.col("_t.item").alias("_hot"), F.col("_t.count").alias("_n"))
    return rows.filter(F.col("_n") > rows_per_piece).select("_hot", F.ceil(F.col("_n") / rows_per_piece).cast("int").alias("_pieces"))


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "left",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Join many rows to a table with one row per key; rows of heavy keys are split.

    Each heavy key gets pieces in proportion to its rows, chosen by a hash of the
    ``spread`` columns (the same on every attempt of a task), and its one table row is
    repeated once per piece.  The list of heavy keys is at most ``HOT_KEYS`` rows, so it
    is safe to broadcast whatever the data size.
    """
    hot = F.broadcast(heavy_keys(facts, keys, rows_per_piece))
    piece = F.pmod(F.xxhash64(*spread), F.col("_pieces")).cast("int")
    hashed = facts.withColumn("_hot", _key_hash(keys)).join(hot, "_hot", "left")
    split = hashed.withColumn("_piece", F.coalesce(piece, F.lit(0))).drop("_pieces", "_hot")
    pieces = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    spread_dim = dim.withColumn("_hot", _key_hash(keys)).join(hot, "_hot", "left").withColumn("_piece", pieces).drop("_pieces", "_hot")
    return split.join(spread_dim, [*keys, "_piece"], how).drop("_piece")


def lookup_anti(facts: DataFrame, keys_frame: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Rows whose key is not in ``keys_frame``; rows of heavy keys are split."""
    known = keys_frame.select(*keys).distinct().withColumn("_known", F.lit(True))
    return lookup_join(facts, known, keys, spread).filter("_known is null").drop("_known")


def _chunked(df: DataFrame, order: str, chunk_rows: int) -> DataFrame:
    return df.withColumn("_chunk", F.expr(f"`{order}` div {int(chunk_rows)}L"))


def _same(keys: list[tuple[str, str]]) -> Column:
    match = F.lit(True)
    for left, right in keys:
        match = match & F.col(left).eqNullSafe(F.col(right))
    return match


def _sums_before(totals: DataFrame, group: list[str], width: int) -> DataFrame:
    """``_before``: the sum of ``_t`` over smaller chunks ``_c`` of a group.

    ``width`` is the order range of a chunk.  Chunks are summed inside chunks of ``FAN`` chunks, and so
    on upwards, until the whole range of LONG has at most about ``2 * FAN`` chunks: no window ever
    holds more rows than that, however sparse the order column is.
    """
    inside = lambda *keys: Window.partitionBy(*(keys or (F.lit(0),))).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    if width * FAN > 2**63 - 1:
        return totals.withColumn("_before", F.coalesce(F.sum("_t").over(inside(*group)), F.lit(0)))
    nested = totals.withColumn("_up", F.expr(f"_c div {FAN}L"))
    summed = nested.withColumn("_inside", F.coalesce(F.sum("_t").over(inside(*group, "_up")), F.lit(0)))
    parents = nested.groupBy(*group, F.col("_up").alias("_c")).agg(F.sum("_t").alias("_t"))
    above = _sums_before(parents, group, width * FAN).select(
        *[F.col(g).alias(f"_u{i}") for i, g in enumerate(group)], F.col("_c").alias("_uc"), F.col("_before").alias("_above")
    )
    match = (F.col("_up") == F.col("_uc")) & _same([(g, f"_u{i}") for i, g in enumerate(group)])
    joined = summed.join(above, match).withColumn("_before", F.col("_inside") + F.col("_above"))
    return joined.select(*group, "_c", "_t", "_before")


def running_sum(
    df: DataFrame, group: list[str], order: str, value, out: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Running sum in ``order`` (whole numbers, no repeats in a group), without one task per group.

    Rows are summed inside chunks of the order range, chunk totals are summed in turn,
    and every row adds the total of the chunks before its own.
    """
    rows = _chunked(df, order, chunk_rows).withColumn("_v", F.coalesce(value, F.lit(0)).cast("long"))
    totals = rows.groupBy(*group, F.col("_chunk").alias("_c")).agg(F.sum("_v").alias("_t"))
    offsets = _sums_before(totals, group, chunk_rows).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_c", "_before"
    )
    match = (F.col("_chunk") == F.col("_c")) & _same([(g, f"_g{i}") for i, g in enumerate(group)])
    inside = Window.partitionBy(*group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_s", F.sum("_v").over(inside))
    joined = summed.join(offsets, match, "left").withColumn(out, F.col("_s") + F.col("_before"))
    return joined.select(*df.columns, out)


def position(df: DataFrame, group: list[str], order: str, out: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """1-based place of each row in its group (or in the whole table) in ``order``."""
    return running_sum(df, group, order, F.lit(1), out, chunk_rows)

