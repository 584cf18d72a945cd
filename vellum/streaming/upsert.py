"""Payload stream to register versions, and read convergence as it arrives."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vellum.operators.documents import write_gate_code
from vellum.operators.register import rejected_payloads
from vellum.operators.sequences import MAX_ATTEMPTS, MIN_ATTEMPT, STABLE_READS
from vellum.sources.buckets import BUCKETS
from vellum.sources.snapshots import is_committed, read_snapshot, upsert_version


def upsert_batch(
    root: str,
    columns: list[str],
    prepare: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    stream: str = "",
    rejected: Callable[[DataFrame, int], None] | None = None,
    buckets: int = BUCKETS,
):
    """``foreachBatch`` function: gated payloads of a micro-batch make the next version, in the
    buckets of the register that they touch.

    ``prepare(payloads, register)`` may match references and fill relation columns first.
    A batch of ``stream`` that was committed before is skipped, so a retried batch changes
    nothing, while a stream with another checkpoint goes on from the newest version.
    ``rejected(payloads, batch_id)`` gets the payloads that the gate or a missing number
    keeps out, with their ``code``. Version 0 is the register the stream starts from.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, root, stream, batch_id):
            return
        payloads = prepare(batch, read_snapshot(spark, root)) if prepare else batch
        coded = payloads.withColumn("code", write_gate_code())
        passed = coded.filter("code = ''").drop("code")
        if rejected:
            gated = coded.filter("code <> ''").withColumn("action", F.lit("rejected"))
            rejected(gated.unionByName(rejected_payloads(passed), allowMissingColumns=True), batch_id)
        upsert_version(passed, root, columns, stream, batch_id, buckets)

    return run


def stream_upsert(stream: DataFrame, root: str, columns: list[str], checkpoint: str, prepare=None, rejected=None):
    """Start the upsert of a payload stream (rows need ``ord``); processes what is there."""
    return (
        stream.writeStream.foreachBatch(upsert_batch(root, columns, prepare, checkpoint, rejected))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class _Convergence(StatefulProcessor):
    """Per page: items seen, reads so far, length of the unchanged streak, and whether the page has stopped.

    Numbers that were skipped count as unchanged reads; a read that arrives in pieces counts once. What a page has seen goes
    when it stops; only the mark that it has stopped is kept.
    """

    def __init__(self, max_attempts: int):
        self.max_attempts = max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getMapState("items", "item string", "seen boolean")
        self.reads = handle.getValueState("reads", "attempt int, merged long, stable int, done boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        attempt, merged, stable, done = self.reads.get() if self.reads.exists() else (0, 0, 0, False)
        by_attempt: dict[int, set[str]] = {}
        expected = 0
        for row in rows if not done else ():
            by_attempt.setdefault(row["attempt"], set()).add(row["item"])
            expected = max(expected, row["expected"] or 0)
        result = Row("page", "stop_attempt", "merged_count")
        for number in sorted(by_attempt):
            if done or number > self.max_attempts:
                break
            while attempt + 1 < number and not done:
                attempt, stable = attempt + 1, stable + 1
                done = stable >= STABLE_READS and attempt >= MIN_ATTEMPT
            if not done:
                fresh = [i for i in by_attempt[number] if not self.items.containsKey((i,))]
                for item in fresh:
                    self.items.updateValue((item,), (True,))
                if fresh:
                    stable = 0
                elif number > attempt:
                    stable += 1
                attempt, merged = max(attempt, number), merged + len(fresh)
                done = (stable >= STABLE_READS and attempt >= MIN_ATTEMPT) or 0 < expected <= merged
            if done:
                self.items.clear()
                yield result(key[0], attempt, merged)
        self.reads.update((attempt, merged, stable, done))

    def close(self) -> None:
        pass


def convergence_stream(stream: DataFrame, max_attempts: int = MAX_ATTEMPTS, expected: str | None = None) -> DataFrame:
    """Stream of pages that have converged; input rows ``(page, attempt, item)``.

    ``expected`` names a column with the number that a page announces: a page that has reached it stops with that read.
    A page is read at most ``max_attempts`` times, so the reads of one page in a micro-batch are few.
    Needs the RocksDB state store.
    """
    announced = F.col(expected).cast("long") if expected else F.lit(None).cast("long")
    rows = stream.select(F.col("page").cast("long"), F.col("attempt").cast("int"), F.col("item").cast("string"), announced.alias("expected"))
    return rows.groupBy("page").transformWithState(
        statefulProcessor=_Convergence(max_attempts),
        outputStructType="page long, stop_attempt int, merged_count long",
        outputMode="Append",
        timeMode="None",
    )
