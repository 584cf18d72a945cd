"""Missing references run by run: only a run's changed keys are written, and any run can be rebuilt.

``changes/version=<n>`` holds the keys that are new, resolved or changed in run ``n``, ``base/version=<n>`` from
time to time all keys of a run, so that no rebuild reads more than ``BASE_EVERY`` runs. ``history`` has one row per
run and commits it: changes without their history row are overwritten by the next attempt.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.operators.skew import running_sum
from vellum.operators.validation import history_row
from vellum.sources.files import append_history

BASE_EVERY = 32
HISTORY = "version long, run_ts string, current_missing long, previous_missing long, new_missing long, resolved_missing long, persistent_missing long, net_delta long"


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed run."""
    rows = _stored(spark, f"{root}/history", HISTORY)
    return spark.createDataFrame([], HISTORY) if rows is None else rows


def read_missing(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The missing keys of a run, by default of the last one; None before the first.

    Per key the last change up to the run counts, combined on the map side.
    """
    last = read_history(spark, root).agg(F.max("version")).first()[0]
    version = last if version is None else version
    if last is None or version > last:
        return None
    start = version - (version - 1) % BASE_EVERY - 1 if version else 0
    base = None if start == 0 else _stored(spark, f"{root}/base")
    changes = _stored(spark, f"{root}/changes")
    if changes is None:
        return None
    changes = changes.filter(F.col("version").between(start + 1, version))
    if base is not None:
        changes = changes.unionByName(base.filter(F.col("version") == start).withColumn("state", F.lit("new")))
    content = F.struct(*[c for c in changes.columns if c not in ("key", "version")])
    newest = changes.groupBy("key").agg(F.max_by(content, "version").alias("c"))
    return newest.filter("c.state <> 'resolved'").select("key", "c.*").drop("state")


def write_missing_snapshot(missing: DataFrame, root: str, run: str, runs: DataFrame | None = None) -> DataFrame:
    """Store the missing keys of one or many runs and give the history.

    ``missing`` has one row per run and key, with whatever else is kept of a key; ``runs`` names the runs
    (column ``run``) where one may have no missing key. ``run`` sorts as text; runs up to the last stored one
    are left as they are. Each key is sent to its own run and the next one, so all runs are compared in one pass.
    """
    spark = missing.sparkSession
    newest = read_history(spark, root).agg(F.max("version").alias("v"), F.max("run_ts").alias("r")).first()
    done = newest["v"] or 0
    content = [c for c in missing.columns if c not in (run, "key")]
    rows = missing.select(F.col(run).cast("string").alias("run_ts"), "key", F.struct(*content).alias("now"))
    names = (missing if runs is None else runs).select(F.col(run).cast("string").alias("run_ts")).distinct()
    if newest["r"] is not None:
        names = names.filter(F.col("run_ts") > newest["r"])
    # one row per run: the window holds the runs, not the keys
    runs = names.withColumn("version", (F.row_number().over(Window.orderBy("run_ts")) + F.lit(done)).cast("long"))
    placed = rows.join(F.broadcast(runs), "run_ts").drop("run_ts")
    before = read_missing(spark, root)
    if before is not None:
        placed = placed.unionByName(before.select("key", F.struct(*content).alias("now"), F.lit(done).cast("long").alias("version")))
    kept = F.struct(F.col("version"), F.col("now"), F.lit(None).cast(placed.schema["now"].dataType).alias("then"))
    next_run = F.struct((F.col("version") + 1).alias("version"), F.lit(None).cast(placed.schema["now"].dataType).alias("now"), F.col("now").alias("then"))
    both = placed.select("key", F.inline(F.array(kept, next_run))).groupBy("version", "key").agg(F.max("now").alias("now"), F.max("then").alias("then"))
    state = (
        F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "resolved").when(~F.col("now").eqNullSafe(F.col("then")), "changed")
    )
    stated = both.withColumn("state", state).filter(f"state is not null and version > {done}").join(F.broadcast(runs.select("version")), "version", "left_semi")
    changes = stated.select("version", "key", F.coalesce("now", "then").alias("c"), "state").select("version", "key", "c.*", "state")
    changes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{root}/changes")
    history = _history(spark, root, runs, done)
    append_history(history, f"{root}/history")
    last = read_history(spark, root).agg(F.max("version")).first()[0] or 0
    for version in range(done - done % BASE_EVERY + BASE_EVERY, last + 1, BASE_EVERY):
        base = read_missing(spark, root, version)
        if base is None:
            continue
        base.withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{root}/base")
    return read_history(spark, root)


def _history(spark: SparkSession, root: str, runs: DataFrame, done: int) -> DataFrame:
    """History rows of the new runs, from the counts of their changes and the number of keys before them."""
    before = read_history(spark, root).filter(F.col("version") == done).select("current_missing").first()
    start = before[0] if before else 0
    none = "version long, state string"
    written = _stored(spark, f"{root}/changes")
    written = spark.createDataFrame([], none) if written is None else written
    counts = written.filter(F.col("version") > done).groupBy(F.col("version").cast("long").alias("version")).agg(
        F.count_if(F.col("state") == "new").alias("new_missing"), F.count_if(F.col("state") == "resolved").alias("resolved_missing")
    )
    each = runs.join(counts, "version", "left").fillna(0)
    summed = running_sum(each, [], "version", F.col("new_missing") - F.col("resolved_missing"), "net")
    current = F.col("net") + start
    summary = summed.select(
        "version", F.col("run_ts").alias("_run"), current.alias("current_missing"),
        (current - F.col("new_missing") + F.col("resolved_missing")).alias("previous_missing"), "new_missing", "resolved_missing",
        (current - F.col("new_missing")).alias("persistent_missing"), (F.col("new_missing") - F.col("resolved_missing")).alias("net_delta"),
    )
    return history_row(summary, F.col("_run")).select(*[c.split()[0] for c in HISTORY.split(", ")])
