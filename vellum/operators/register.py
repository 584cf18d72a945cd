"""Register snapshots: each change is a function of the old snapshot and the changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum import labels as L
from vellum.functions.dates import parse_cleanup_time, parse_date_value
from vellum.functions.text import clean_text, match_key
from vellum.operators.skew import key_counts, lookup_anti, lookup_join, position


# --- lookups ------------------------------------------------------------------------------
def _indexes(register: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """Lowest row per exact number, and per match key: one row per key, also among copies."""
    named = register.select(clean_text("number").alias("_raw"), F.col(row).alias("_r")).filter("_raw <> ''")
    exact = named.groupBy("_raw").agg(F.min("_r").alias("_exact_row"))
    keyed = named.withColumn("_key", match_key("_raw")).filter("_key <> ''")
    return exact, keyed.groupBy("_key").agg(F.min("_r").alias("_key_row"))


def resolve_rows(targets: DataFrame, register: DataFrame, row: str = "_row_number") -> DataFrame:
    """``target_row`` for each distinct ``number``: exact spelling first, then match key."""
    exact, keyed = _indexes(register, row)
    rows = targets.withColumn("_raw", clean_text("number")).withColumn("_key", match_key("number"))
    joined = rows.join(exact, "_raw", "left").join(keyed, "_key", "left")
    found = F.coalesce("_exact_row", "_key_row")
    how = F.when(F.col("_exact_row").isNotNull(), "exact").when(F.col("_key_row").isNotNull(), "normalised").otherwise("none")
    return joined.withColumn("target_row", found).withColumn("matched_by", how).drop("_raw", "_key", "_exact_row", "_key_row")


def lookup_best(targets: DataFrame, register: DataFrame, spread: list[str]) -> DataFrame:
    """Row lookup for many targets: distinct numbers are resolved once, then handed back."""
    numbers = key_counts(targets, ["number"]).select("number")
    return lookup_join(targets, resolve_rows(numbers, register), ["number"], spread)


def lookup_row_or_number(targets: DataFrame, register: DataFrame) -> DataFrame:
    """By given row number when it exists, else by exact number; the first row wins."""
    rows = register.groupBy(F.col("_row_number").cast("string").alias("_rn")).agg(F.min("_row_number").alias("_by_row"))
    numbers = register.filter(clean_text("number") != "").groupBy(clean_text("number").alias("_no")).agg(
        F.min("_row_number").alias("_by_number")
    )
    wanted = targets.withColumn("_rn", clean_text(F.col("target_row_number").cast("string"))).withColumn("_no", clean_text("target_number"))
    joined = lookup_join(wanted, rows, ["_rn"], ["target_id"])
    joined = lookup_join(joined, numbers, ["_no"], ["target_id"])
    return joined.withColumn("found_row", F.coalesce("_by_row", "_by_number")).drop("_rn", "_no", "_by_row", "_by_number")


def duplicate_flags(df: DataFrame, register: DataFrame, spread: list[str]) -> DataFrame:
    """``is_duplicate``: the number stands in the register, exactly or by match key."""
    best = lookup_best(df, register, spread)
    return best.withColumn("is_duplicate", F.col("target_row").isNotNull()).drop("target_row", "matched_by")


# --- views --------------------------------------------------------------------------------
def view_status() -> Column:
    """``transferred``, then ``irrelevant``, else ``pending``."""
    return (
        F.when(clean_text("process_status") == L.TRANSFERRED, "transferred")
        .when(clean_text("approval_status") == L.IRRELEVANT, "irrelevant")
        .otherwise("pending")
    )


def status_view(register: DataFrame, view: str) -> DataFrame:
    """Rows of one view; the irrelevant list looks at the approval status alone."""
    if view == "all":
        return register
    if view == "irrelevant":
        return register.filter(clean_text("approval_status") == L.IRRELEVANT)
    return register.filter(view_status() == view)


def status_views(register: DataFrame) -> DataFrame:
    """All views from one scan: each row once per view it is in, with ``view_name``."""
    own = F.when(view_status() != "irrelevant", view_status())
    irrelevant = F.when(clean_text("approval_status") == L.IRRELEVANT, F.lit("irrelevant"))
    names = F.array_compact(F.array(own, irrelevant, F.lit("all")))
    return register.withColumn("view_name", F.explode(names))


def register_counts(register: DataFrame) -> DataFrame:
    status = view_status()
    return register.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(status == v).alias(v) for v in ["transferred", "irrelevant", "pending"]],
    )


# --- transfer -----------------------------------------------------------------------------
def classify_transfer(staging: DataFrame, official: DataFrame) -> DataFrame:
    """``missing`` columns and ``outcome`` of a transfer request for each staging row.

    Rows are taken in row order: of several complete rows with the same number the first
    goes through and the later ones meet it as a duplicate.
    """
    gaps = [F.when(clean_text(c) == "", F.lit(c)) for c in L.TRANSFER_REQUIRED]
    rows = staging.withColumn("missing", F.array_compact(F.array(*gaps)))
    flagged = duplicate_flags(rows, official, ["_row_number"])
    key = F.when(match_key("number") == "", clean_text("number")).otherwise(match_key("number"))
    keyed = flagged.withColumn("_key", key)
    ready = keyed.filter((F.size("missing") == 0) & ~F.col("is_duplicate"))
    firsts = ready.groupBy("_key").agg(F.min("_row_number").alias("_first"))
    joined = lookup_join(keyed, firsts, ["_key"], ["_row_number"])
    outcome = (
        F.when(F.size("missing") > 0, "missing_fields")
        .when(F.col("is_duplicate") | (F.col("_row_number") > F.col("_first")), "duplicate")
        .otherwise("ok")
    )
    return joined.withColumn("outcome", outcome).drop("_key", "_first", "is_duplicate")


def transfer(staging: DataFrame, official: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """New staging (statuses written) and the rows to append to the official register."""
    judged = classify_transfer(staging, official)
    ok = F.col("outcome") == "ok"
    status = (
        F.when(ok, F.lit(L.TRANSFERRED))
        .when(F.col("outcome") == "duplicate", F.lit(L.DUPLICATE_NUMBER))
        .otherwise(F.lit(L.MANUAL_CHECK))
    )
    marked = judged.withColumns(
        {
            "process_status": status,
            "approval_status": F.when(ok, F.lit(L.CHECKED)).otherwise(F.col("approval_status")),
            "status_date": F.when(ok, at).otherwise(F.col("status_date")),
        }
    )
    moved = judged.filter(ok).withColumn("status_date", at).drop("outcome", "missing")
    # Appended at the end of the official register, in staging order.
    last = official.agg(F.coalesce(F.max("_row_number"), F.lit(1)).alias("m")).scalar()
    placed = position(moved, [], "_row_number", "_place").withColumn("_row_number", (last + F.col("_place")).cast("long"))
    return marked.drop("missing"), placed.drop("_place")


# --- upsert -------------------------------------------------------------------------------
def is_rejected() -> Column:
    """A payload without a number has no row to go to."""
    return clean_text("number") == ""


def rejected_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads that no upsert takes, each with its ``action`` and code."""
    return payloads.filter(is_rejected()).withColumns({"action": F.lit("rejected"), "code": F.lit("MISSING_SO_HIEU")})


def resolve_payloads(payloads: DataFrame, register: DataFrame) -> DataFrame:
    """Payloads with the register row they go to, or the key of the row they will create."""
    named = payloads.filter(~is_rejected())
    placed = lookup_best(named, register, ["ord"])
    key = F.when(match_key("number") == "", clean_text("number")).otherwise(match_key("number"))
    return placed.withColumn("_new_key", F.when(F.col("target_row").isNull(), key))


def upsert_protected(
    register: DataFrame,
    payloads: DataFrame,
    columns: list[str],
    protected: list[str] | None = None,
    only_blank: bool = False,
    last_row: int | None = None,
) -> DataFrame:
    """The register after all payloads, in their order, with all its columns.

    Payloads without a number are in ``rejected_payloads``. Columns of a new row that payloads do
    not bring are blank texts, or NULL if they are no texts.

    Several payloads for one row fold to one first: the last gives ordinary columns, the
    first non-blank value counts for protected ones (once set they stay).  An old
    protected value stays when it is not blank.  With ``only_blank`` ordinary columns are
    filled only where the old value is blank.  New rows follow the last row number in
    payload order; ``last_row`` gives it where ``register`` is only a part.
    """
    protected = L.PROTECTED_COLUMNS if protected is None else protected
    guarded = [c for c in columns if c in protected]
    plain = [c for c in columns if c not in protected]
    placed = resolve_payloads(payloads, register)
    blank = lambda c: clean_text(c) == ""
    newest = F.max(F.struct("ord", *plain)).alias("_last")
    oldest = [F.min(F.when(~blank(c), F.struct("ord", c))).alias(f"_p_{c}") for c in guarded]
    folded = placed.groupBy("target_row", "_new_key").agg(newest, F.min("ord").alias("_ord"), *oldest)
    value = lambda c: F.coalesce(F.col(f"_p_{c}")[c] if c in guarded else F.col("_last")[c], F.lit(""))
    changes = folded.select("target_row", "_ord", *[value(c).alias(f"_new_{c}") for c in columns])

    def merged(c: str) -> Column:
        old, new = F.col(c), F.col(f"_new_{c}")
        if c in guarded:
            pick = F.when(~blank(c) | blank(f"_new_{c}"), old).otherwise(new)
        elif only_blank:
            pick = F.when(~blank(c), old).otherwise(new)
        else:
            pick = new
        return F.when(F.col("_ord").isNull(), old).otherwise(pick)

    hits = changes.filter("target_row is not null").withColumnRenamed("target_row", "_row_number")
    updated = register.join(hits, "_row_number", "left").select(
        *[merged(c).alias(c) if c in columns else F.col(c) for c in register.columns],
        F.when(F.col("_ord").isNotNull(), "updated").otherwise("kept").alias("action"),
    )
    fresh = position(changes.filter("target_row is null"), [], "_ord", "_place")
    last = register.agg(F.coalesce(F.max("_row_number"), F.lit(1)).alias("m")).scalar() if last_row is None else F.lit(last_row)
    kinds = dict(register.dtypes)

    def created(c: str) -> Column:
        if c == "_row_number":
            return (last + F.col("_place")).cast("long")
        return F.col(f"_new_{c}") if c in columns else F.lit("" if kinds[c] == "string" else None).cast(kinds[c])

    inserted = fresh.select(*[created(c).alias(c) for c in register.columns], F.lit("inserted").alias("action"))
    return updated.unionByName(inserted)


# --- cell updates -------------------------------------------------------------------------
def apply_updates(register: DataFrame, updates: DataFrame, columns: list[str]) -> DataFrame:
    """Set cells ``(row_number, column, value, ord)``; the last of several counts.

    Unknown columns and the forbidden process status are ignored.
    """
    valid = updates.filter(
        F.col("column").isin(columns)
        & ~((F.col("column") == "process_status") & F.col("value").eqNullSafe(F.lit(L.IRRELEVANT)))
    )
    last = valid.groupBy(F.col("row_number").alias("_row_number"), "column").agg(F.max(F.struct("ord", "value"))["value"].alias("value"))
    maps = last.groupBy("_row_number").agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("_set"))
    joined = register.join(maps, "_row_number", "left")
    cells = {
        c: F.when(F.map_contains_key("_set", c), F.col("_set")[c]).otherwise(F.col(c)) for c in columns if c in register.columns
    }
    return joined.withColumns(cells).drop("_set")


def stamp_status_date(register: DataFrame, changed: Column, now: Column) -> DataFrame:
    """Where the approval status changed: date on entering "irrelevant", kept if set, cleared on leaving."""
    date = (
        F.when(~changed, F.col("status_date"))
        .when(clean_text("approval_status") != L.IRRELEVANT, F.lit(""))
        .when(clean_text("status_date") == "", now)
        .otherwise(F.col("status_date"))
    )
    return register.withColumn("status_date", date)


def purge_irrelevant(register: DataFrame, now: Column, days: int = L.RETENTION_DAYS) -> DataFrame:
    """Rows without those irrelevant for at least ``days`` whole days; undated rows stay."""
    since = parse_cleanup_time("status_date")
    seconds = F.timestamp_diff("SECOND", since, now)
    old = (clean_text("approval_status") == L.IRRELEVANT) & (seconds >= days * 86400)
    return register.filter(~F.coalesce(old, F.lit(False)))


def sort_register(register: DataFrame, by: str = "effective_date") -> DataFrame:
    """Newest typed date first, undated last."""
    return register.orderBy(parse_date_value(by).desc_nulls_last(), "_row_number")


def keep_newest(log: DataFrame, order: str, n: int = L.LOG_ROWS_KEPT) -> DataFrame:
    return log.orderBy(F.desc(order)).limit(n)


# --- expiry -------------------------------------------------------------------------------
def expired_cascade(register: DataFrame, expired: DataFrame, relation_columns: list[str] | None = None) -> DataFrame:
    """Drop rows whose number expired and take expired numbers out of the other rows' lists.

    ``expired`` holds ``number``.  List entries travel as (row, column, entry); only the
    hits come back, as one small set per row, so the lists themselves are not shuffled.
    A cell is rewritten with comma and blank only when an entry was removed.
    """
    columns = [c for c in (relation_columns or L.CLEANED_ON_EXPIRY) if c in register.columns]
    gone = expired.select(F.lower(clean_text("number")).alias("_gone")).filter("_gone <> ''").distinct()
    keyed = register.withColumn("_gone", F.lower(clean_text("number")))
    kept = lookup_anti(keyed, gone, ["_gone"], ["_row_number"]).drop("_gone")
    listed = F.array_distinct(F.flatten(F.array(*[F.transform(_entries(c), F.lower) for c in columns])))
    entries = register.select("_row_number", F.explode(listed).alias("_gone"))
    hits = lookup_join(entries, gone.withColumn("_hit", F.lit(True)), ["_gone"], ["_row_number"], "inner")
    removed = hits.groupBy("_row_number").agg(F.collect_set("_gone").alias("_removed"))
    joined = kept.join(removed, "_row_number", "left")

    def cell(c: str) -> Column:
        items = _entries(c)
        left = F.filter(items, lambda v: ~F.array_contains("_removed", F.lower(v)))
        changed = F.col("_removed").isNotNull() & (F.size(left) < F.size(items))
        return F.when(changed, F.array_join(left, ", ")).otherwise(F.col(c))

    return joined.withColumns({c: cell(c) for c in columns}).drop("_removed")


def _entries(c: str) -> Column:
    """Trimmed, non-blank entries of a list cell, repeats kept."""
    raw = F.split(clean_text(c), r"[\n,;]+")
    return F.filter(F.transform(raw, clean_text), lambda v: v != "")


def mark_expired_log(log: DataFrame, at: Column, dry_run: bool) -> DataFrame:
    """Log rows that are due get their end status and time; ``is_due`` is in the row already."""
    waiting = clean_text("status").isin(L.EXPIRY_WAITING, L.EXPIRY_FUTURE)
    done = waiting & F.col("is_due") & (clean_text("old_number") != "")
    status = F.lit(L.EXPIRY_SIMULATED if dry_run else L.EXPIRY_DELETED)
    return log.withColumns(
        {
            "status": F.when(done, status).otherwise(F.col("status")),
            "deleted_at": F.when(done, at).otherwise(F.col("deleted_at")),
        }
    )


def retire_expired(register: DataFrame, log: DataFrame, as_of: Column, at: Column, dry_run: bool = True) -> tuple[DataFrame, DataFrame]:
    """New register and new log after the daily run; a dry run leaves the register as it is."""
    from vellum.operators.expiry import expiry_due, with_due

    new_log = mark_expired_log(with_due(log, as_of), at, dry_run).drop("is_due")
    if dry_run:
        return register, new_log
    due = expiry_due(log, as_of)
    return expired_cascade(register, due.select(F.col("old_number").alias("number"))), new_log
