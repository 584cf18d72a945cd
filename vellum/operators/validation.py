"""Outcomes of submissions, run verdict and the run's text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import clean_text
from vellum.operators.skew import first_n_by

SECTION_CAPS = {"invalid": 40, "warning": 30, "result_error": 40, "no_match_report": 30, "relation_missing": 40, "new_missing": 20}


def result_outcome(results: DataFrame, dry_run: Column | bool = False) -> DataFrame:
    """``outcome``, ``severity`` and ``missing_relations`` of each submission.

    ``result`` is the JSON answer of a sent payload.
    """
    dry = F.lit(dry_run) if isinstance(dry_run, bool) else dry_run
    answer = F.try_parse_json("result")
    # Only the JSON value true counts, not a text or number that reads as true.
    flag = F.try_variant_get(answer, "$.ok", "variant")
    is_flag = F.coalesce(F.schema_of_variant(flag) == "BOOLEAN", F.lit(False))
    ok = is_flag & F.coalesce(F.try_variant_get(answer, "$.ok", "boolean"), F.lit(False))
    action = F.coalesce(F.try_variant_get(answer, "$.result.write_result.action", "string"), F.lit(""))
    report_type = T_MAP
    report = F.from_json(F.get_json_object("result", "$.result.match_report"), report_type)
    missing = F.aggregate(
        F.coalesce(F.map_values(report), F.array().cast("array<" + T_ENTRY + ">")),
        F.lit(0),
        lambda n, r: n + F.coalesce(F.size(r["missing_items"]), F.lit(0)),
    )
    has_report = F.coalesce(F.size(report) > 0, F.lit(False))
    status = clean_text("status")
    outcome = (
        F.when((status == "sent") & ~ok, "not_ok")
        .when((status == "sent") & (action == "skipped"), "write_skipped")
        .when((status == "sent") & ~has_report, "no_match_report")
        .when((status == "sent") & (missing > 0), "relations_missing")
        .when(status == "sent", "success")
        .when(status.isin("error", "invalid", "skipped"), F.concat(F.lit("status_"), status))
        .when((status == "dry_run") & ~dry, "unexpected_dry_run")
        .when(status == "dry_run", "dry_run")
        .otherwise("unknown_status")
    )
    rows = results.withColumns({"outcome": outcome, "missing_relations": F.when(status == "sent", F.coalesce(missing, F.lit(0))).otherwise(F.lit(0))})
    errors = ["not_ok", "write_skipped", "status_error", "status_invalid", "status_skipped", "unexpected_dry_run"]
    severity = F.when(F.col("outcome").isin(errors), "error").when(
        F.col("outcome").isin("no_match_report", "dry_run", "unknown_status"), "warning"
    )
    return rows.withColumn("severity", severity.otherwise("none"))


T_ENTRY = "struct<matched_ids:array<string>,matched_details:array<map<string,string>>,missing_items:array<map<string,string>>>"
T_MAP = f"map<string,{T_ENTRY}>"


def result_counts(outcomes: DataFrame) -> DataFrame:
    """Result numbers of the run in one pass."""
    o = F.col("outcome")
    return outcomes.agg(
        F.count(F.lit(1)).alias("results"),
        F.count_if(F.col("severity") == "error").alias("result_errors"),
        F.count_if(F.col("severity") == "warning").alias("result_warnings"),
        F.count_if(o.isin("success", "relations_missing", "no_match_report")).alias("sent_success"),
        F.count_if(o == "not_ok").alias("sent_not_ok"),
        F.count_if(o == "write_skipped").alias("sent_skipped"),
        F.count_if(o == "no_match_report").alias("sent_without_report"),
        F.count_if(F.col("missing_relations") > 0).alias("relation_missing_documents"),
    )


def run_verdict(summary: DataFrame) -> DataFrame:
    """``ok``, ``errors`` and ``warnings`` of a run from its one-row summary."""

    def rule(code: str, count: str) -> Column:
        return F.when(F.col(count) > 0, F.concat(F.lit(code + ":"), F.col(count).cast("string")))

    errors = F.array_compact(
        F.array(
            rule("config_errors", "config_errors"),
            F.when(F.col("documents") <= 0, F.lit("no_documents")),
            rule("invalid_documents", "invalid_documents"),
            rule("invalid_payloads", "invalid_payloads"),
            rule("result_errors", "result_errors"),
            rule("sent_not_ok", "sent_not_ok"),
            rule("sent_skipped", "sent_skipped"),
            rule("sent_without_report", "sent_without_report"),
        )
    )
    warnings = F.array_compact(
        F.array(
            rule("relation_missing_documents", "relation_missing_documents"),
            rule("warned_documents", "warned_documents"),
            rule("result_warnings", "result_warnings"),
        )
    )
    return summary.withColumns({"errors": errors, "warnings": warnings}).withColumn("ok", F.size("errors") == 0)


def capped_sections(lines: DataFrame, section: str, order: list, caps: dict[str, int] | None = None) -> DataFrame:
    """Report lines with at most the section's cap each; sections without a cap stay whole."""
    caps = caps or SECTION_CAPS
    largest = max(caps.values())
    limits = F.create_map(*[F.lit(x) for pair in caps.items() for x in pair])
    limited = lines.filter(F.map_contains_key(limits, F.col(section)))
    kept = first_n_by(limited, [section], order, largest, rank="_rank")
    kept = kept.filter(F.col("_rank") <= F.element_at(limits, F.col(section))).drop("_rank")
    return kept.unionByName(lines.filter(~F.map_contains_key(limits, F.col(section))))


def history_row(delta: DataFrame, run_ts: Column) -> DataFrame:
    """One history row of a run from its delta summary."""
    return delta.select(run_ts.alias("run_ts"), "*")
