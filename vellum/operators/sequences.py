"""Order-based operators: running totals, read convergence, stop rules, numbering, line cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.text import contains_any, normalize_text, sequence_id
from vellum.operators.skew import position, running_sum

MAX_ATTEMPTS, STABLE_READS, MIN_ATTEMPT = 8, 2, 4


def running_totals(pages: DataFrame, field: list[str]) -> DataFrame:
    """Documents so far after each page; needs ``page_index`` and ``new_count``."""
    return running_sum(pages, field, "page_index", F.col("new_count"), "total_so_far")


def snapshot_convergence(
    attempts: DataFrame, page: list[str], item: str, expected: str | None = None, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Where reading a page may stop: nothing new twice in a row from the fourth read on,
    or the expected number reached.

    A page is read at most ``max_attempts`` times (a rule of the reading, as a parameter). Each item
    needs only its first read, and each page one count per read: combined on the map side, no window.
    """
    group = [*page, expected] if expected else page
    reads = attempts.filter(F.col("attempt").between(1, max_attempts))
    firsts = reads.groupBy(*group, item).agg(F.min("attempt").cast("int").alias("_first"), F.max("attempt").alias("_last"))
    fresh = firsts.groupBy(*group, "_first").agg(F.count(F.lit(1)).alias("_n"), F.max("_last").alias("_last"))
    wide = fresh.groupBy(*group).agg(
        F.max("_last").alias("attempts"), F.map_from_entries(F.collect_list(F.struct("_first", "_n"))).alias("_fresh")
    )

    def read(state: Column, k: Column) -> Column:
        n = F.coalesce(F.try_element_at("_fresh", k), F.lit(0).cast("long"))
        stable = F.when(n == 0, state["stable"] + 1).otherwise(F.lit(0))
        total = state["total"] + n
        stop = (k >= MIN_ATTEMPT) & (stable >= STABLE_READS)
        if expected:
            stop = stop | ((F.col(expected) > 0) & (total >= F.col(expected)))
        after = F.struct(total.alias("total"), stable.alias("stable"), F.when(stop, k).alias("stop"))
        return F.when(state["stop"].isNotNull(), state).otherwise(after)

    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("stable"), F.lit(None).cast("int").alias("stop"))
    done = wide.withColumn("_s", F.aggregate(F.sequence(F.lit(1), F.col("attempts").cast("int")), start, read))
    stop = F.col("_s")["stop"]
    return done.select(
        *page, "attempts", stop.alias("stop_attempt"), stop.isNotNull().alias("converged"), F.col("_s")["total"].alias("merged_count")
    )


def empty_streak_stop(pages: DataFrame, field: list[str]) -> DataFrame:
    """Second of two consecutive empty pages per field, NULL when there is none.

    Each empty page is sent to its own and the next page number, so that the rule is an
    aggregation on (field, page) and not a window over a whole field.
    """
    empty = pages.filter("document_count = 0").select(
        *field, F.explode(F.array(F.struct(F.col("page_index").alias("p"), F.lit(1).alias("own"), F.lit(0).alias("prev")),
                                  F.struct((F.col("page_index") + 1).alias("p"), F.lit(0).alias("own"), F.lit(1).alias("prev")))).alias("e")
    )
    pairs = empty.groupBy(*field, F.col("e.p").alias("p")).agg(F.max("e.own").alias("own"), F.max("e.prev").alias("prev"))
    stops = pairs.filter("own = 1 and prev = 1").groupBy(*field).agg(F.min("p").alias("stop_page"))
    fields = pages.groupBy(*field).agg(F.max("page_index").alias("last_page"))
    return fields.join(stops, field, "left")


def pages_before_stop(pages: DataFrame, field: list[str]) -> DataFrame:
    """Pages up to and with the stop page."""
    stops = empty_streak_stop(pages, field).select(*field, "stop_page")
    kept = pages.join(stops, field, "left")
    return kept.filter("stop_page is null or page_index <= stop_page").drop("stop_page")


def assign_sequence(df: DataFrame, order: str, start: int = 174) -> DataFrame:
    """Ids ``VBnnn`` over all rows in ``order``, counted in chunks."""
    numbered = position(df, [], order, "_place")
    return numbered.withColumn("sequence_id", sequence_id(F.col("_place") + F.lit(start - 1))).drop("_place")


def listing_numbering(df: DataFrame, field: list[str], order: str) -> DataFrame:
    """Readable place of each document in its field."""
    return position(df, field, order, "list_position")


# --- lines of one page (arrays in the page's own row, nothing is shuffled) ---------------
# Each step is a column of its own, so that a step is worked out once per page and not
# once per line that looks at it.
def slice_between_markers(
    pages: DataFrame, lines: str, out: str, starts: list[str] | None = None, ends: list[str] | None = None
) -> DataFrame:
    """Lines after the first start marker and before the first end marker that follows."""
    if starts is None:
        is_start = lambda x: contains_any(x, L.LIST_START_MARKERS) | (
            F.contains(x, F.lit("Có tất cả")) & F.contains(x, F.lit("văn bản"))
        )
    else:
        is_start = lambda x: contains_any(x, starts)
    found = pages.withColumn("_start", F.array_position(F.transform(lines, is_start), True).cast("int"))
    rest = found.withColumn("_rest", F.slice(lines, F.col("_start") + 1, F.greatest(F.size(lines) - F.col("_start"), F.lit(0))))
    stop = F.array_position(F.transform("_rest", lambda x: contains_any(x, ends or L.LIST_END_MARKERS)), True).cast("int")
    cut = rest.withColumn("_stop", stop)
    part = F.when(F.col("_stop") > 0, F.slice("_rest", F.lit(1), F.col("_stop") - 1)).otherwise(F.col("_rest"))
    return cut.withColumn(out, part).drop("_start", "_rest", "_stop")


def numbered_rows(pages: DataFrame, lines: str, keep: list[str], markers: list[str] | None = None) -> DataFrame:
    """One row per numbered line: its number and its title, which runs to the first stop
    marker or the next numbered line.  Rows without a title are left out."""
    markers = markers or L.ROW_STOP_MARKERS
    begins = F.transform(lines, lambda x, i: F.when(F.regexp_like(x, F.lit(r"^\d{1,4}(?:\s+.+)?$")), i + 1))
    found = pages.select(*keep, F.col(lines).alias("_lines"), F.array_compact(begins).alias("_starts"))
    bounded = found.withColumn("_bounds", F.concat("_starts", F.array(F.size("_lines") + 1)))
    pieces = F.transform(
        "_starts", lambda place, i: F.slice("_lines", place, F.get(F.col("_bounds"), i + 1) - place)
    )
    rows = bounded.select(*keep, F.explode(pieces).alias("_piece"))
    head = F.get("_piece", F.lit(0))
    stop = F.array_position(
        F.transform("_piece", lambda x, i: (i > 0) & contains_any(x, markers)), True
    ).cast("int")
    rows = rows.withColumns({"_head": head, "_stop": stop})
    last = F.get("_piece", F.col("_stop") - 1)
    cut = F.coalesce(*[F.when(F.contains(last, F.lit(m)), F.substring_index(last, m, 1)) for m in markers], F.lit(""))
    end = F.when(F.col("_stop") > 0, F.col("_stop") - 1).otherwise(F.size("_piece"))
    texts = F.concat(
        F.array(F.regexp_extract("_head", r"^\d{1,4}\s+(.+)$", 1)), F.slice("_piece", F.lit(2), F.greatest(end - 1, F.lit(0))),
        F.when(F.col("_stop") > 0, F.array(cut)).otherwise(F.array().cast("array<string>")),
    )
    title = F.array_join(F.filter(F.transform(texts, normalize_text), lambda x: x != ""), " ")
    named = rows.select(
        *keep, F.regexp_extract("_head", r"^(\d{1,4})", 1).cast("int").alias("number"), normalize_text(title).alias("title")
    )
    return named.filter("title <> ''")
