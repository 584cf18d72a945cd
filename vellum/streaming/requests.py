"""Request checks: size, headers, time, replay.  Batch form and stream form share the rules."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vellum import labels as L
from vellum.operators.skew import lookup_join
from vellum.sources.staging import staged, staged_count

TTL_SECONDS, FUTURE_SKEW_SECONDS, MAX_BODY_BYTES = 300, 30, 1_000_000


def static_code(ttl: int = TTL_SECONDS, skew: int = FUTURE_SKEW_SECONDS, max_bytes: int = MAX_BODY_BYTES) -> Column:
    """First failing rule that needs no other request; blank when none fails.

    ``arrival_s`` is the arrival in epoch seconds, ``raw_timestamp`` the sender's text.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    age = F.col("arrival_s") - F.col("raw_timestamp").try_cast("double")
    return (
        F.when(F.octet_length(F.coalesce("body", F.lit(""))) > max_bytes, "BODY_TOO_LARGE")
        .when(blank("raw_timestamp") | blank("request_id"), "MISSING_SIGNATURE_HEADERS")
        .when(age.isNull(), "INVALID_TIMESTAMP")
        .when(age > ttl, "TIMESTAMP_EXPIRED")
        .when(age < -skew, "TIMESTAMP_FUTURE")
        .otherwise("")
    )


def _sight_links(valid: DataFrame, ttl: int) -> DataFrame:
    """One row ``(request_id, arrival_s, ord, starts, next)`` per id and second.

    ``starts``: no sight of the id in the ``ttl`` seconds before, so the second is accepted whatever came
    earlier.  ``next``: the first sight more than ``ttl`` seconds later, unless that one starts anew.

    Seconds lie in spans of ``ttl + 1``.  Two sights over ``ttl`` apart never share a span, and what a second
    looks for lies in its own span and its neighbours, or behind a gap, where the next sight starts anew.  So each second
    is sent to its own span and to the two that follow, and every window holds at most three spans.
    """
    width = ttl + 1
    seconds = valid.groupBy("request_id", "arrival_s").agg(F.min("ord").alias("ord"))
    off = F.pmod(F.col("arrival_s"), F.lit(width))
    placed = seconds.withColumn("_off", off).withColumn("_span", (F.col("arrival_s") - F.col("_off")) / width)
    sent = placed.select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("_from")).withColumn("_span", F.col("_span") + F.col("_from"))
    span = Window.partitionBy("request_id", "_span")
    later = span.orderBy(F.desc("_off")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own, near, far = (F.col("_from") == k for k in range(3))
    first, latest = F.min(F.when(own, F.col("_off"))).over(span), F.max(F.when(near, F.col("_off"))).over(span)
    marked = sent.withColumns({"_first": first, "_latest": latest})
    starts = own & (F.col("_first") == F.col("_off")) & ~F.coalesce(F.col("_latest") > F.col("_off"), F.lit(False))
    marked = marked.withColumn("_starts", starts).drop("_first", "_latest")
    sight = F.when(own, F.struct("arrival_s", "ord", F.col("_starts").alias("starts")))
    found = marked.withColumn("_next", F.when(near, F.min(sight).over(later)).when(far, F.min(sight).over(span)))
    rows = found.groupBy("request_id", "arrival_s", "ord").agg(
        F.max("_starts").alias("starts"), F.max(F.when(near, F.col("_next"))).alias("_near"), F.max(F.when(far, F.col("_next"))).alias("_far")
    )
    first = F.coalesce("_near", "_far")
    return rows.select("request_id", "arrival_s", "ord", "starts", F.when(~first["starts"], first.dropFields("starts")).alias("next"))


def accepted_sights(valid: DataFrame, ttl: int = TTL_SECONDS) -> DataFrame:
    """Accepted sights ``(request_id, arrival_s, ord)``: the first, then each first one more
    than ``ttl`` seconds after the last accepted.

    Every second of an id links to the one that would be accepted after it; the chains from the
    seconds that start anew are followed by doubling the links, all in rows: after ``k`` steps, links
    span ``2**k`` sights, and the accepted sights are reached by steps of falling length.
    """
    links = staged(_sight_links(valid, ttl))
    steps = []
    jump, rows = staged_count(links.filter("next is not null").select("request_id", "arrival_s", "next"))
    while rows:
        steps.append(jump)
        onward = jump.select("request_id", F.col("arrival_s").alias("_to"), F.col("next").alias("_then"))
        reached = jump.withColumn("_to", F.col("next.arrival_s")).join(onward, ["request_id", "_to"])
        jump, rows = staged_count(reached.select("request_id", "arrival_s", F.col("_then").alias("next")))
    taken = links.filter("starts").select("request_id", "arrival_s", "ord")
    for step in reversed(steps):
        both = F.array_compact(F.array(F.struct("arrival_s", "ord"), F.col("next")))
        taken = taken.join(step, ["request_id", "arrival_s"], "left").select("request_id", F.inline(both))
    return taken


def request_audit(
    requests: DataFrame, ttl: int = TTL_SECONDS, skew: int = FUTURE_SKEW_SECONDS, max_bytes: int = MAX_BODY_BYTES, replay_ttl: int | None = None
) -> DataFrame:
    """``code`` per request of a batch; only requests without another fault are remembered.

    ``arrival_s`` must be whole seconds (LONG).  Ids are remembered for ``replay_ttl``
    seconds, by default as long as a timestamp is valid.
    """
    rows = requests.withColumn("code", static_code(ttl, skew, max_bytes))
    accepted = accepted_sights(rows.filter("code = ''"), replay_ttl or ttl).select(
        "request_id", "arrival_s", F.col("ord").alias("_accepted")
    )
    joined = lookup_join(rows, accepted, ["request_id", "arrival_s"], ["ord"])
    replay = (F.col("code") == "") & ~F.coalesce(F.col("_accepted") == F.col("ord"), F.lit(False))
    return joined.withColumn("code", F.when(replay, "REPLAY_DETECTED").otherwise(F.col("code"))).drop("_accepted")


class _Replays(StatefulProcessor):
    """Per id: the second of the last accepted request, held until the watermark passes its time to live.

    A micro-batch needs one row per second of an id; of equal seconds the least ``order`` is taken.
    """

    def __init__(self, ttl: int, columns: list[str], order: str):
        self.ttl, self.columns, self.order = ttl, columns, columns.index(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "second long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[int, Row] = {}
        accepted = Row(*self.columns)
        for row in rows:
            held = first.get(row[-1])
            if held is None or row[self.order] < held[self.order]:
                first[row[-1]] = row
        last = self.last.get()[0] if self.last.exists() else None
        before = last
        for second in sorted(first):
            if last is None or second - last > self.ttl:
                last = second
                yield accepted(*first[second][:-1])
        if last != before:
            if before is not None:
                self.handle.deleteTimer(self._over(before))
            self.last.update((last,))
            self.handle.registerTimer(self._over(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def _over(self, second: int) -> int:
        return (second + self.ttl + 1) * 1000

    def close(self) -> None:
        pass


def replay_filter(stream: DataFrame, ttl: int = TTL_SECONDS, time: str = "arrival_ts", key: str = "request_id", order: str = "ord") -> DataFrame:
    """Stream of accepted requests, by the rule of ``request_audit``: the first sight of an id, then each
    first one more than ``ttl`` seconds after the last accepted, however the stream is cut into micro-batches.

    Seconds of ``time`` count.  Requests may come up to ``ttl`` seconds out of order; one that comes
    after a later one of its id was accepted counts as a replay of it.  An id's state goes
    when the watermark passes its time to live.  Needs the RocksDB state store.
    """
    rows = stream.withWatermark(time, f"{ttl} seconds").withColumn("_second", F.unix_seconds(F.date_trunc("second", F.col(time).cast("timestamp"))))
    return rows.groupBy(key).transformWithState(
        statefulProcessor=_Replays(ttl, stream.columns, order), outputStructType=stream.schema, outputMode="Append", timeMode="EventTime"
    )


def audit_stream(stream: DataFrame, ttl: int = TTL_SECONDS, skew: int = FUTURE_SKEW_SECONDS, max_bytes: int = MAX_BODY_BYTES) -> DataFrame:
    """Stream of accepted requests: without a fault of their own and not replayed."""
    return replay_filter(stream.filter(static_code(ttl, skew, max_bytes) == ""), ttl)


def daily_once(alerts: DataFrame, time: str = "event_ts", zone: str = L.LOCAL_ZONE) -> DataFrame:
    """At most one alert per task and local day, whatever the session's time zone; in batch and on a stream."""
    local = F.convert_timezone(None, F.lit(zone), F.col(time).cast("timestamp_ntz"))
    day = alerts.withColumn("sent_date", local.cast("date"))
    if not alerts.isStreaming:
        return day.dropDuplicates(["task_id", "sent_date"])
    return day.withWatermark(time, "1 day").dropDuplicatesWithinWatermark(["task_id", "sent_date"])
