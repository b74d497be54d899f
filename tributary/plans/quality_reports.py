"""Reports over the quality event log.

Counts are read from the JSON text of `details`. The per-rule reports explode the
short list of rules of each record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import percent
from tributary.operators.rollup import tally

EXPECTATIONS = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


def _progress(log: DataFrame) -> DataFrame:
    return log.filter("event_type = 'flow_progress'")


def _detail(path: str):
    return F.get_json_object("details", f"$.flow_progress.{path}")


def flow_counts(log: DataFrame) -> DataFrame:
    """(timestamp, table_name, rows_passed, rows_dropped) of each record with quality data."""
    return (
        _progress(log)
        .filter(_detail("data_quality").isNotNull())
        .select(
            "timestamp",
            F.col("origin.flow_name").alias("table_name"),
            _detail("metrics.num_output_rows").cast("bigint").alias("rows_passed"),
            _detail("data_quality.dropped_records").cast("bigint").alias("rows_dropped"),
        )
    )


def rule_events(log: DataFrame) -> DataFrame:
    """One row per record and rule."""
    rules = F.from_json(_detail("data_quality.expectations"), EXPECTATIONS)
    return (
        _progress(log)
        .select("timestamp", F.col("origin.flow_name").alias("table_name"), F.explode(rules).alias("e"))
        .select(
            "timestamp",
            "table_name",
            F.col("e.dataset").alias("dataset"),
            F.col("e.name").alias("expectation"),
            F.col("e.passed_records").alias("passed_records"),
            F.col("e.failed_records").alias("failed_records"),
        )
    )


def rows_processed_vs_dropped(log: DataFrame) -> DataFrame:
    counts = tally(
        flow_counts(log),
        "table_name",
        rows_passed=F.sum("rows_passed"),
        rows_dropped=F.sum("rows_dropped"),
    )
    seen = F.col("rows_passed") + F.col("rows_dropped")
    return counts.withColumn("drop_rate_pct", percent(F.col("rows_dropped"), seen)).orderBy(
        F.desc("rows_dropped"), "table_name"
    )


def expectation_breakdown(log: DataFrame) -> DataFrame:
    counts = tally(
        rule_events(log).withColumn("table_name", F.col("dataset")),
        ["table_name", "expectation"],
        passed_records=F.sum("passed_records"),
        failed_records=F.sum("failed_records"),
    ).withColumn("total_records", F.col("passed_records") + F.col("failed_records"))
    return counts.withColumn("pass_rate_pct", percent(F.col("passed_records"), F.col("total_records"))).orderBy(
        F.desc("failed_records"), "table_name", "expectation"
    )


def top_failing_expectations(log: DataFrame) -> DataFrame:
    return tally(
        rule_events(log).filter("failed_records > 0").withColumn("table_name", F.col("dataset")),
        ["expectation", "table_name"],
        total_failures=F.sum("failed_records"),
    ).orderBy(F.desc("total_failures"), "expectation", "table_name")


def drop_rate_trend(log: DataFrame) -> DataFrame:
    return tally(
        flow_counts(log).withColumn("run_hour", F.date_trunc("hour", "timestamp")),
        ["run_hour", "table_name"],
        rows_passed=F.sum("rows_passed"),
        rows_dropped=F.sum("rows_dropped"),
    ).orderBy("run_hour", "table_name")


def expectation_event_log(log: DataFrame) -> DataFrame:
    return (
        rule_events(log)
        .select("timestamp", "table_name", "expectation", "passed_records", "failed_records")
        .orderBy(F.desc("timestamp"), F.desc("failed_records"), "table_name", "expectation")
        .limit(200)
    )


# --- widget roll-ups -----------------------------------------------------------


def widget_rows_by_table(log: DataFrame) -> DataFrame:
    return tally(
        rows_processed_vs_dropped(log),
        "table_name",
        rows_passed=F.sum("rows_passed"),
        rows_dropped=F.sum("rows_dropped"),
    )


def widget_failures_by_rule(log: DataFrame) -> DataFrame:
    return tally(top_failing_expectations(log), "expectation", total_failures=F.sum("total_failures"))


def widget_pass_fail_by_rule(log: DataFrame) -> DataFrame:
    return tally(
        expectation_breakdown(log),
        "expectation",
        passed_records=F.sum("passed_records"),
        failed_records=F.sum("failed_records"),
    )


def widget_dropped_by_hour(log: DataFrame) -> DataFrame:
    return tally(drop_rate_trend(log), ["run_hour", "table_name"], rows_dropped=F.sum("rows_dropped"))


REPORTS = {
    "dq_rows_processed_vs_dropped": rows_processed_vs_dropped,
    "dq_expectation_breakdown": expectation_breakdown,
    "dq_top_failing_expectations": top_failing_expectations,
    "dq_drop_rate_trend": drop_rate_trend,
    "dq_expectation_event_log": expectation_event_log,
    "dq_widget_rows_by_table": widget_rows_by_table,
    "dq_widget_failures_by_rule": widget_failures_by_rule,
    "dq_widget_pass_fail_by_rule": widget_pass_fail_by_rule,
    "dq_widget_dropped_by_hour": widget_dropped_by_hour,
}
