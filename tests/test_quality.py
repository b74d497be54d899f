"""Rules, quarantine, event log and entity cleaning."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from small import by, rows

from tributary.functions.labels import latency_bucket
from tributary.functions.scalars import lenient_double, lenient_int, numeric_text, places, text_flag
from tributary.operators.event_log import batch_log
from tributary.operators.expectations import drop, enforce, fail, quarantine, rejected, rule_counts, warn
from tributary.plans import quality_reports, silver

CLICK = (
    "event_id string, visitor_id string, search_guid string, opening_uid string, position string, "
    "event_ts string, is_bot string, time_to_click_secs string"
)
# One good click and one of each kind of dirt.
CLICKS = [
    ("CLK_1", "v1", "g1", "j1", "6", "2024-01-15T18:44:05.000+0000", "False", "8"),
    ("CLK_2", "v1", "g2", "j1", "1", "2024-01-15T09:00:00.000+0000", "False", "8"),
    ("CLK_2", "v2", "g3", "j2", "1", "2024-01-15T09:00:00.000+0000", "False", "8"),
    ("CLK_3", "v2", "g3", "j2", "3", "2024-01-15T10:00:00.000+0000", "False", "-5"),
    ("CLK_4", "v3", "g4", None, "2", "2024-01-15T11:00:00.000+0000", "False", "15"),
    ("CLK_5", "v3", "g4", "j3", "4", "2024-01-15T11:05:00.000+0000", "True", "1"),
    ("CLK_6", "v4", "g5", "j3", "1", "2024-01-15T12:00:00.000+0000", "False", "instant"),
    ("CLK_7", "v4", "g5", "j3", "top", "2025-09-15T08:00:00.000+0000", "False", "10"),
    (None, "v4", "g5", "j3", "1", "2024-01-15T08:00:00.000+0000", "False", "10"),
    (None, None, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def clicks(spark):
    return spark.createDataFrame(CLICKS, CLICK).withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def test_clicks_are_cast_before_they_are_checked(clicks):
    kept = rows(silver.click_events(clicks))
    assert sorted(str(r["event_id"]) for r in kept) == ["CLK_1", "CLK_2", "CLK_2", "CLK_3", "None"]
    counts = by(rule_counts(silver.typed_clicks(clicks), silver.CLICK_RULES), "expectation")
    failed = {k: r["failed_records"] for k, r in counts.items()}
    assert failed == {
        "valid_visitor_id": 1,
        "valid_search_guid": 1,
        "valid_opening_uid": 2,
        "valid_position": 2,
        "valid_time_to_click_secs": 2,
        "valid_visitors": 1,
    }
    assert all(r["passed_records"] + r["failed_records"] == len(CLICKS) for r in counts.values())


def test_accepted_and_rejected_make_up_the_source(clicks):
    typed = silver.typed_clicks(clicks)
    accepted = enforce(typed, silver.CLICK_RULES)
    both = accepted.unionAll(rejected(typed, silver.CLICK_RULES))
    assert sorted(map(str, both.collect())) == sorted(map(str, typed.collect()))


def test_quarantine_names_the_first_reason(clicks):
    got = rows(silver.quarantine_clicks(clicks))
    reasons = sorted((str(r["event_id"]), r["quarantine_reason"]) for r in got)
    assert reasons == [
        ("CLK_4", "valid_opening_uid"),
        ("CLK_5", "bot_traffic"),
        ("CLK_6", "valid_time_to_click_secs"),
        ("CLK_7", "invalid_position"),
        # The other click without an id breaks no rule of silver and is accepted there.
        ("None", "null_event_id"),
    ]
    renamed = quarantine(silver.typed_clicks(clicks), [drop("a", "position < 3")], [drop("far down", "position < 3")])
    assert {r["quarantine_reason"] for r in rows(renamed)} == {"far down"}


def test_quarantine_and_silver_are_all_clicks(clicks):
    both = silver.click_events(clicks).unionAll(silver.quarantine_clicks(clicks).drop("quarantine_reason"))
    assert sorted(map(str, both.collect())) == sorted(map(str, silver.typed_clicks(clicks).collect()))


def test_documented_rules_keep_organic_clicks(clicks):
    typed = silver.documented_clicks(clicks)
    rules = silver.documented_rules("2024-02-01 00:00:00")["click_events"]
    kept = rows(enforce(typed, rules))
    assert {r["event_id"] for r in kept} == {f"CLK_{n}" for n in (1, 2, 3, 4, 6, 7)}
    failed = {k: r["failed_records"] for k, r in by(rule_counts(typed, rules), "expectation").items()}
    assert failed["not_negative_time"] == 1
    assert failed["not_future_event"] == 2


def test_null_predicate_counts_as_violation_and_warn_keeps_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    seen = Observation()
    assert enforce(df, [warn("positive", "x > 0")], seen).count() == 3
    assert (seen.get["rows_in"], seen.get["rows_dropped"], seen.get["failed_positive"]) == (3, 0, 2)
    assert enforce(df, [drop("positive", "x > 0")]).count() == 1


def test_fail_rule_stops_the_job(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert enforce(df.filter("x = 1"), [fail("known", "x IS NOT NULL")]).count() == 1
    with pytest.raises(PySparkException, match="expectation failed: known"):
        enforce(df, [fail("known", "x IS NOT NULL")]).collect()


def test_event_log_record_and_reports(spark, clicks):
    typed = silver.typed_clicks(clicks)
    log = batch_log(typed, silver.CLICK_RULES, "silver.click_events", F.lit("2024-01-16 03:20:00").cast("timestamp"))
    record = rows(log)[0]
    details = json.loads(record["details"])["flow_progress"]
    assert record["event_type"] == "flow_progress" and record["origin"]["flow_name"] == "silver.click_events"
    assert details["metrics"]["num_output_rows"] == 5
    assert details["data_quality"]["dropped_records"] == 5
    assert details["data_quality"]["expectations"][3] == {
        "name": "valid_position",
        "dataset": "silver.click_events",
        "passed_records": 8,
        "failed_records": 2,
    }
    assert rows(quality_reports.rows_processed_vs_dropped(log))[0]["drop_rate_pct"] == 50.0
    assert len(rows(quality_reports.top_failing_expectations(log))) == 6
    assert str(rows(quality_reports.drop_rate_trend(log))[0]["run_hour"]) == "2024-01-16 03:00:00"
    other = log.withColumn("event_type", F.lit("update_progress"))
    assert rows(quality_reports.expectation_breakdown(other)) == []


def test_entity_cleaning(spark):
    jobs = spark.createDataFrame([("j1", "negotiable"), ("j2", "-500"), ("j3", "50")], "opening_uid string, budget_amount string")
    got = by(silver.clean_jobs(jobs), "opening_uid")
    assert [got[k]["numeric_budget_amount"] for k in ("j1", "j2", "j3")] == [None, -500.0, 50.0]
    assert "budget_amount" not in got["j1"]


def test_scalars(spark):
    df = spark.createDataFrame([("instant",), ("-5",), ("7.5",), ("True",), (None,)], "x string")
    got = df.select(
        lenient_double("x").alias("d"), lenient_int("x").alias("i"), numeric_text("x").alias("n"), text_flag("x").alias("f")
    ).collect()
    assert [r.d for r in got] == [None, -5.0, 7.5, None, None]
    assert [r.n for r in got] == [None, -5.0, 7.5, None, None]
    assert [r.i for r in got][:2] == [None, -5]
    assert [r.f for r in got] == [False, False, False, True, False]
    assert spark.range(1).select(places(F.lit(1.005), 2)).first()[0] == 1.01


def test_latency_buckets(spark):
    seconds = [None, -5.0, 2.9, 3.0, 10.0, 30.0, 60.0, 7200.0]
    df = spark.createDataFrame([(s,) for s in seconds], "s double")
    labels = [r[0] for r in df.select(latency_bucket(F.col("s"))).collect()]
    assert labels == ["unknown", "< 3s (instant)", "< 3s (instant)", "3-10s", "10-30s", "30-60s", "> 60s", "> 60s"]
