"""Hot keys: the running plans split them, and results stay whole."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from small import click, rows, search, shown, tables

from tributary import registry, session
from tributary.operators.quantiles import band_of, weighted_quantiles
from tributary.plans import marts_exact, star
from tributary.plans.marts_funnel import Funnel, funnel_fact
from tributary.plans.silver import SilverTables

LOW_THRESHOLDS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def low_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in LOW_THRESHOLDS}
    for key, value in LOW_THRESHOLDS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(spark) -> SilverTables:
    """60,000 impressions; one search, shown with 5,000 jobs, holds a third of them."""
    searches = [search(f"g{n}", f"v{n % 97}", f"q{n % 5}") for n in range(500)] + [search("hot", "v1", "q1")]
    base = tables(spark, searches, [shown("i", "g", "j")], [click("c", "g1", "j1", 5.0)])
    guid = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500))
    impressions = spark.range(60_000).select(
        F.concat(F.lit("i"), "id").alias("event_id"),
        F.concat(F.lit("v"), F.col("id") % 97).alias("visitor_id"),
        guid.alias("search_guid"),
        F.concat(F.lit("j"), F.col("id") % 5000).alias("opening_uid"),
        (F.col("id") % 9).cast("int").alias("position"),
        F.lit("2024-01-15 09:00:00").cast("timestamp").alias("event_ts"),
        F.lit("2024-01-15 09:00:00").cast("timestamp").alias("collector_ts"),
        F.lit(False).alias("is_bot"),
    )
    clicks = impressions.filter(F.col("event_id").endswith("0"))
    clicks = clicks.withColumn("time_to_click_secs", F.col("position") * 2.0)
    return SilverTables(base.searches, impressions, clicks, base.jobs, base.clients, base.freelancers)


def _final_plan(df) -> str:
    """The plan AQE ended with after all rows were produced."""
    totals = df.groupBy().agg(F.count(F.lit(1)), *[F.max(F.col(c).cast("string")) for c in df.columns])
    totals.collect()
    return totals._jdf.queryExecution().executedPlan().toString()


def test_hot_search_is_split_in_the_fact(hot, low_thresholds):
    fact = star.fact_search_events(hot)
    assert "SortMergeJoin(skew=true)" in _final_plan(fact)
    assert fact.count() == 60_000


def test_hot_search_is_split_in_the_funnel(hot, low_thresholds):
    assert "SortMergeJoin(skew=true)" in _final_plan(funnel_fact(hot))
    assert "SortMergeJoin(skew=true)" in _final_plan(Funnel(hot).cells())


def test_one_hot_triple_is_split(spark, hot, low_thresholds):
    """A third of all impressions by one visitor, of one job, in one search."""
    same = F.col("search_guid") == "hot"
    impressions = hot.impressions.withColumns(
        {
            "visitor_id": F.when(same, "v1").otherwise(F.col("visitor_id")),
            "opening_uid": F.when(same, "j1").otherwise(F.col("opening_uid")),
        }
    )
    silver = SilverTables(hot.searches, impressions, hot.clicks, hot.jobs, hot.clients, hot.freelancers)
    plan = _final_plan(star.fact_search_events(silver))
    assert plan.count("SortMergeJoin(skew=true)") >= 2
    # The marts reduce the triple to one cell before any join.
    cells = Funnel(silver).cells()
    assert cells.filter("search_guid = 'hot'").count() == 1
    assert cells.agg(F.sum("impressions")).first()[0] >= 20_000


def test_counts_of_hot_groups_are_whole(hot):
    got = {r["search_query"]: r for r in rows(marts_exact.search_query_performance(hot))}
    assert sum(r["impressions"] for r in got.values()) == 60_000
    assert got["q1"]["unique_jobs_shown"] == 5000


def test_quantiles_of_a_hot_group_add_values_up_first(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.col("id") % 60).cast("double").alias("v"),
    )
    want = df.groupBy("g").agg(F.expr("percentile(v, array(0.25, 0.5, 0.75))").alias("q"))
    got = weighted_quantiles(df, "g", "v", F.lit(1), [0.25, 0.5, 0.75], "q")
    found = {r.g: r.q for r in got.collect()}
    assert set(found) == {r.g for r in want.collect()}
    for r in want.collect():
        assert found[r.g] == pytest.approx(r.q, rel=1e-12)


@pytest.fixture(params=["coalesced", "many ranges"])
def ranges(spark, request):
    """The same data once as few large bands and once as many small ones."""
    if request.param == "many ranges":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "24")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_over_bands_are_exact(spark, ranges, seed):
    """Groups of one band and of many; weights, ties, outliers and NULL groups included."""
    pick = random.Random(seed)
    data = []
    for group, size in (("hot", 4000), ("wide", 700), ("same", 300), ("few", 3), ("one", 1), (None, 400)):
        for _ in range(size):
            value = {"same": 7.0}.get(group, pick.choice([pick.random() * 60, float(pick.randrange(20)), 1e9, None]))
            data.append((group, value, pick.randrange(0, 4)))
    df = spark.createDataFrame(data, "g string, v double, w int")
    points = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    text = ", ".join(map(str, points))
    repeated = df.filter("w > 0 AND v IS NOT NULL").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("w"))))
    want = repeated.groupBy("g").agg(F.expr(f"percentile(v, array({text}))").alias("q"))
    got = weighted_quantiles(df, "g", "v", F.col("w"), points, "q")
    expected = {r.g: r.q for r in want.collect()}
    found = {r.g: r.q for r in got.collect()}
    assert set(found) == set(expected)
    for group, values in expected.items():
        assert found[group] == pytest.approx(values, rel=1e-12)


def test_quantiles_of_odd_values(spark):
    """Negative, tiny, huge, infinite and undefined values, ties, NULL groups, weights of nothing, an empty table."""
    inf, nan = float("inf"), float("nan")
    values = [-inf, -1e300, -3.5, -3.5, -1e-9, 0.0, 1e-9, 2.0, 2.0000001, 1e6, 1e6 + 0.25, 1e300, inf, nan]
    data = [(g, v, w) for g in (None, "a") for v, w in zip(values, (1, 2, 3, 1, 0, 4, 1, 1, 2, 5, 1, 1, 2, 1))]
    data += [("one", 7.0, 3), ("none", 7.0, 0), ("null", None, 2)]
    df = spark.createDataFrame(data, "g string, v double, w long")
    # 25 values: these ranks are whole.
    points = [0.125, 0.25, 0.5, 0.75]
    flat = sorted((v for g, v, w in data if g == "a" for _ in range(w)), key=lambda v: (v != v, v))
    got = {r["g"]: r["q"] for r in weighted_quantiles(df, "g", "v", F.col("w"), points, "q").collect()}
    assert set(got) == {None, "a", "one"} and got["one"] == [7.0] * 4
    assert got["a"] == got[None] == [flat[int(p * 24)] for p in points]
    assert weighted_quantiles(df.limit(0), "g", "v", F.col("w"), points, "q").count() == 0


def test_bands_rise_with_values(spark):
    values = sorted({s * b * 2.0**e for s in (-1, 1) for e in range(-40, 60, 7) for b in (1, 1.0000001, 1.5, 1.9999999)} | {0.0})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bands = [r["b"] for r in df.select("i", band_of(F.col("v")).alias("b")).orderBy("i").collect()]
    assert bands == sorted(bands) and len(set(bands)) > 60


def test_marts_with_quartiles_read_events_once(spark):
    """The plans over the stored roll-up: few shuffles, and no event is scanned for counts and quartiles again."""
    folder = "/root/testdata/sf0.001"
    for name, shuffles, scans in (("s_job_performance_ctr", 16, 1), ("s_job_click_engagement", 10, 0)):
        plan = registry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"(?<!Reused)Exchange ", plan)) <= shuffles
        assert len(re.findall(r"Scan parquet [^\n]*lineitem", plan)) <= scans


def test_shuffles_are_cut_by_the_size_of_the_tables(spark, tmp_path, monkeypatch):
    """Larger tables get more partitions, not larger ones; a number that is large enough stays."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(initial, None)
    spark.range(20_000).write.parquet(f"{tmp_path}/lineitem.parquet")
    stored = sum(f.stat().st_size for f in tmp_path.glob("lineitem.parquet/*.parquet"))
    monkeypatch.setattr(session, "PARTITION_MB", 1 / 1024)
    try:
        registry.Market(spark, str(tmp_path))
        cut = int(spark.conf.get(initial))
        assert cut >= 2 * stored / 1024 > 100
        session.expect_shuffles_of(spark, 1e-6)
        assert int(spark.conf.get(initial)) == cut
    finally:
        spark.conf.unset(initial) if before is None else spark.conf.set(initial, before)
