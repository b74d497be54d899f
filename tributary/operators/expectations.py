"""Declared quality rules: warn, drop, fail and quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.functions.scalars import count_when

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate; a NULL result counts as a violation."""

    name: str
    predicate: str
    action: str = DROP

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def warn(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, WARN)


def drop(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, DROP)


def fail(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, FAIL)


def all_hold(rules: list[Rule]) -> Column:
    out = F.lit(True)
    for rule in rules:
        out = out & rule.holds
    return out


def counters(rules: list[Rule]) -> list[Column]:
    """Rows in, rows dropped, and violations per rule, for `agg` or `observe`."""
    dropped = count_when(~all_hold([r for r in rules if r.action == DROP]))
    return [
        F.count(F.lit(1)).alias("rows_in"),
        dropped.alias("rows_dropped"),
        *[count_when(~rule.holds).alias(f"failed_{rule.name}") for rule in rules],
    ]


def enforce(df: DataFrame, rules: list[Rule], observation: Observation | str | None = None) -> DataFrame:
    """Apply the rules; counts go to `observation` when the query runs.

    Drop rules are plain filters (a NULL predicate drops the row as well), so
    they can be pushed to the scan when no counters are asked for. Fail rules
    raise inside the job.
    """
    if observation is not None:
        df = df.observe(observation, *counters(rules))
    for rule in rules:
        if rule.action == FAIL:
            stop = F.raise_error(F.lit(f"expectation failed: {rule.name}")).cast("boolean")
            df = df.filter(F.when(rule.holds, F.lit(True)).otherwise(stop))
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(rule.predicate)
    return df


def rejected(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows `enforce` would drop."""
    return df.filter(~all_hold([r for r in rules if r.action == DROP]))


def quarantine(df: DataFrame, rules: list[Rule], reasons: list[Rule] | None = None) -> DataFrame:
    """Rejected rows with `quarantine_reason`: the name of the first violated rule of `reasons`.

    `reasons` are the rules themselves unless other names or another order are wanted.
    """
    reason = F.coalesce(*[F.when(~r.holds, F.lit(r.name)) for r in reasons or rules])
    return rejected(df, rules).withColumn("quarantine_reason", reason)


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(expectation, passed_records, failed_records), one pass over the rows."""
    wide = df.agg(*counters(rules))
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("expectation"),
                (F.col("rows_in") - F.col(f"failed_{r.name}")).alias("passed_records"),
                F.col(f"failed_{r.name}").alias("failed_records"),
            )
            for r in rules
        ]
    )
    return wide.select(F.inline(per_rule))
