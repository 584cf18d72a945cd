"""Connected components of links between whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import staged

#: Links that one task takes whole, 16 bytes each; more go round by round.
AT_ONCE = 1_000_000


def _least(edges: DataFrame) -> DataFrame:
    """(a, m): the least neighbour of each a. Staged, so that the join on a may split a hot a."""
    return staged(edges.groupBy("a").agg(F.min("b").alias("m")))


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every linked node, by hanging roots on lesser roots until none differ."""
    node, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = place[: len(a)], place[len(a) :], np.arange(len(node))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        x, y = x[low < high], y[low < high]
        np.minimum.at(root, high[low < high], low[low < high])
        while (root[root] != root).any():
            root = root[root]
    return node, node[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches, pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        node, root = least_reached(held.column("a").to_numpy(), held.column("b").to_numpy())
        if len(node):
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).coalesce(1).mapInArrow(run, "node bigint, root bigint")


def components(links: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """(node, root): every linked node with the least node it reaches. links: a, b.

    At most ``at_once`` links are solved in one task. More alternate between hanging larger
    neighbours on the least neighbour and smaller neighbours on the least of them, until nothing
    changes; the number of rounds grows with the logarithm of the longest path. Self-links, nulls
    and repeated links are ignored.
    """
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    edges = staged(down.distinct())
    if edges.count() <= at_once:
        return _in_one_task(edges)
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both)
        large = staged(
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        low = _least(large)
        small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
