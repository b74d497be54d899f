"""Distinct counts that add up, against direct ones."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tributary import registry
from tributary.operators import distinct
from tributary.session import kept

FOLDER = "/root/testdata/sf0.001"


def random_rows(spark, seed, size=3000):
    pick = random.Random(seed)
    rows = [(pick.choice([None, 1, 2, 3, 40]), pick.choice("ab"), pick.choice([None, *map(str, range(700))])) for _ in range(size)]
    return spark.createDataFrame(rows + [(9, "a", None)], "day int, kind string, id string")


def direct(rows, by):
    count = {k: F.countDistinct(F.when(F.col("kind") == k, F.col("id"))).alias(k) for k in "ab"}
    return {r[0]: (r["a"], r["b"]) for r in rows.groupBy(by).agg(*count.values()).collect()}


def test_any_coarser_group_is_a_union(spark):
    rows = random_rows(spark, 1)
    codes = kept(distinct.numbered(rows), "test-codes")
    assert codes.select("code").distinct().count() == codes.count() == rows.filter("id IS NOT NULL").select("kind", "id").distinct().count()
    daily = kept(distinct.states(rows, ["day"], codes), "test-states")
    names = {"a": "a", "b": "b"}
    for by, want in (
        (F.col("day"), direct(rows, F.col("day"))),
        ((F.col("day") % 2).alias("day"), direct(rows, F.col("day") % 2)),
        (F.lit("all").alias("day"), direct(rows, F.lit("all"))),
    ):
        got = {r["day"]: (r["a"], r["b"]) for r in distinct.counted(distinct.merged(daily, [by]), ["day"], names).collect()}
        # A group without any id has no state.
        assert got == {k: v for k, v in want.items() if v != (0, 0)}
    # The sets are shared between groups, so sums of the daily counts are too large.
    assert sum(v[0] for v in direct(rows, F.col("day")).values()) > direct(rows, F.lit("all"))["all"][0]


def test_later_ids_keep_earlier_codes(spark):
    """States of two runs with one growing dictionary merge to the counts over all rows."""
    first, second = random_rows(spark, 2, 400), random_rows(spark, 3, 2000)
    codes = kept(distinct.numbered(first), "test-codes")
    more = kept(distinct.numbered(second, codes), "test-codes")
    old = {(r["kind"], r["id"]): r["code"] for r in codes.collect()}
    new = {(r["kind"], r["id"]): r["code"] for r in more.collect()}
    assert old.items() <= new.items() and len(set(new.values())) == len(new) > len(old)
    both = distinct.states(first, ["day"], codes).unionAll(distinct.states(second, ["day"], more))
    total = distinct.counted(distinct.merged(both, [F.lit("all").alias("day")]), ["day"], {"a": "a", "b": "b"}).first()
    assert (total["a"], total["b"]) == direct(first.unionAll(second), F.lit("all"))["all"]


def test_empty_tables(spark):
    rows = random_rows(spark, 1).limit(0)
    codes = kept(distinct.numbered(rows), "test-codes")
    assert distinct.merged(distinct.states(rows, ["day"], codes), ["day"]).count() == 0


def test_days_equal_the_daily_mart_without_expand(spark):
    found = registry.queries()["distinct_by_period"](spark, FOLDER)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Weeks and months come from the stored states: no event is read, nothing is expanded.
    assert "Expand" not in plan and "lineitem" not in plan
    days = {r["period_start"]: tuple(r)[2:] for r in found.filter("grain = 'day'").collect()}
    mart = registry.queries()["p_daily_metrics"](spark, FOLDER).collect()
    assert days == {r["event_date"]: (r["unique_visitors"], r["search_sessions"], r["unique_jobs_shown"]) for r in mart}
