"""The quality event log: one record per flow and run.

Record shape: `timestamp`, `event_type`, `origin.flow_name` and the JSON text
`details` with row counts and the outcome of every rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.expectations import Rule, counters


def progress_record(flow: str, rules: list[Rule]) -> list[Column]:
    """Log columns made of the counter columns of `expectations.counters`."""
    outcomes = [
        F.struct(
            F.lit(rule.name).alias("name"),
            F.lit(flow).alias("dataset"),
            (F.col("rows_in") - F.col(f"failed_{rule.name}")).alias("passed_records"),
            F.col(f"failed_{rule.name}").alias("failed_records"),
        )
        for rule in rules
    ]
    quality = F.struct(
        F.col("rows_dropped").alias("dropped_records"), F.array(*outcomes).alias("expectations")
    )
    metrics = F.struct((F.col("rows_in") - F.col("rows_dropped")).alias("num_output_rows"))
    progress = F.struct(metrics.alias("metrics"), quality.alias("data_quality"))
    return [
        F.lit("flow_progress").alias("event_type"),
        F.struct(F.lit(flow).alias("flow_name")).alias("origin"),
        F.to_json(F.struct(progress.alias("flow_progress"))).alias("details"),
    ]


def batch_log(df: DataFrame, rules: list[Rule], flow: str, run: Column) -> DataFrame:
    """Log records of a table whose rows belong to runs, in one aggregation.

    `run` gives the run's time for a row. Counters are combined per task before
    the shuffle, so a run of any size sends one row per task.
    """
    counted = df.groupBy(run.alias("timestamp")).agg(*counters(rules))
    return counted.select("timestamp", *progress_record(flow, rules))
