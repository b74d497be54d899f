"""Marts on small tables, with the cases in which the two families differ."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from small import by, click, client, job, rows, search, shown, tables

from tributary.plans import marts_exact, marts_funnel, reports, star
from tributary.plans.marts_funnel import Funnel


@pytest.fixture(scope="module")
def market(spark):
    return tables(
        spark,
        searches=[search("g1"), search("g2", "v2", "scala", "featured_jobs", 10), search("g3", "v3", "idle")],
        impressions=[
            shown("i1", "g1", "j1", 1),
            shown("i2", "g1", "j1", 2),
            shown("i3", "g1", "j2", 3),
            shown("i4", "g2", "j1", 1, "v2"),
            shown("i5", "gX", "j1", 5, "v9"),
        ],
        clicks=[
            click("c1", "g1", "j1", 5.0),
            click("c2", "g1", "j1", 7.0, hour=8),
            click("c3", "g2", "j1", 30.0, "v2", hour=23),
        ],
        jobs=[job("j1"), job("j2", "Design", "c2"), job("j3", "Data", "c3", None, False)],
        clients=[client("c1"), client("c2", "Beta")],
    )


def test_job_performance_keeps_null_without_clicks(market):
    got = by(marts_exact.job_performance(market), "opening_uid")
    assert (got["j1"]["impressions"], got["j1"]["clicks"], got["j1"]["ctr_pct"]) == (4, 3, 75.0)
    assert got["j1"]["median_time_to_click_secs"] == 7.0
    assert (got["j2"]["impressions"], got["j2"]["clicks"], got["j2"]["ctr_pct"]) == (1, None, None)
    assert got["j3"]["impressions"] is None


def test_unmatched_impressions_form_a_null_group_without_clicks(market):
    got = by(marts_exact.search_query_performance(market), "search_query")
    assert got[None]["impressions"] == 1
    assert got[None]["clicks"] is None
    assert got["spark"]["clicks"] == 2


def test_daily_marts_date_clicks_differently(spark):
    silver = tables(
        spark,
        searches=[search("g1", hour=23)],
        impressions=[shown("i1", "g1", "j1")],
        clicks=[("c1", "v1", "g1", "j1", 1, *(2 * [search("x", hour=1)[-1].replace(day=16)]), False, 3.0)],
    )
    assert rows(marts_exact.daily_metrics(silver))[0]["clicks"] is None
    assert rows(marts_funnel.daily_metrics(Funnel(silver)))[0]["clicks"] == 1


def test_repeated_search_id_multiplies_impressions_but_not_clicks(spark):
    silver = tables(
        spark,
        searches=[search("g1"), search("g1")],
        impressions=[shown("i1", "g1", "j1")],
        clicks=[click("c1", "g1", "j1", 5.0)],
    )
    got = rows(marts_exact.search_query_performance(silver))[0]
    assert (got["impressions"], got["clicks"]) == (2, 1)


def test_funnel_keeps_idle_searches_and_fans_out(market):
    fact = rows(marts_funnel.funnel_fact(market))
    assert sum(r["search_guid"] == "g3" for r in fact) == 1
    assert sum(r["search_guid"] == "g1" and r["opening_uid"] == "j1" for r in fact) == 4
    assert not any(r["search_guid"] == "gX" for r in fact)


def test_null_job_stands_for_idle_searches(market):
    got = by(marts_funnel.job_performance_ctr(Funnel(market)), "opening_uid")
    assert (got[None]["impressions"], got[None]["unique_impression_visitors"], got[None]["ctr_pct"]) == (0, 1, None)
    assert (got["j1"]["impressions"], got["j1"]["clicks"], got["j1"]["avg_impression_position"]) == (5, 5, 1.4)
    assert got["j1"]["click_time_quantiles"] == [5.0, 7.0, 7.0]
    assert got["j2"]["click_time_quantiles"] is None


def _naive(fact, key):
    return by(
        fact.groupBy(key).agg(
            F.count("impression_id").alias("impressions"),
            F.count("click_id").alias("clicks"),
            F.countDistinct("visitor_id").alias("visitors"),
            F.countDistinct("opening_uid").alias("jobs"),
            F.avg("time_to_click_secs").alias("seconds"),
            F.avg("position").alias("position"),
            F.expr("percentile(time_to_click_secs, array(0.25, 0.5, 0.75))").alias("quartiles"),
        ),
        key,
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """Random rows; one search, one job and one pair hold a third each."""
    pick = random.Random(7)

    def guid():
        return pick.choice(["hot", *[f"g{n}" for n in range(40)]]) if pick.random() < 0.7 else "hot"

    def opening():
        return "hotjob" if pick.random() < 0.35 else f"j{pick.randrange(30)}"

    def name(prefix, n):
        return None if pick.random() < 0.03 else f"{prefix}{n}"

    searches = [search(f"g{n}", f"v{n % 7}", f"q{n % 5}", hour=n % 24) for n in range(45)]
    searches += [search("hot", "vh", "q1"), search("g1", "v8", "q2")]
    impressions = [shown(name("i", n), guid(), opening(), pick.randrange(1, 9)) for n in range(1500)]
    clicks = [
        click(name("c", n), guid(), opening(), None if pick.random() < 0.1 else float(pick.randrange(60)))
        for n in range(400)
    ]
    jobs = [job(f"j{n}", f"cat{n % 4}") for n in range(30)] + [job("hotjob", "cat1")]
    return tables(spark, searches, impressions, clicks, jobs)


@pytest.mark.parametrize("stored", [False, True])
def test_marts_over_cells_equal_marts_over_rows(skewed, lake, stored):
    """The weighted cells give what the fanned-out rows give, also with hot groups."""
    fact = marts_funnel.funnel_fact(skewed).cache()
    funnel = Funnel(skewed)
    if stored:
        funnel = Funnel(skewed, lake.materialize(funnel.cells(by_time=True, by_position=True), "gold", "cells"))

    def close(a, b, digits):
        return (a is None and b is None) or abs(a - b) <= 0.5 * 10**-digits + 1e-9

    want = _naive(fact, "opening_uid")
    got = by(marts_funnel.job_performance_ctr(funnel), "opening_uid")
    assert set(got) == set(want)
    for key, row in got.items():
        assert (row["impressions"], row["clicks"]) == (want[key]["impressions"], want[key]["clicks"])
        assert row["unique_impression_visitors"] == want[key]["visitors"]
        assert row["click_time_quantiles"] == want[key]["quartiles"]
        assert close(row["avg_click_time"], want[key]["seconds"], 1)
        assert close(row["avg_impression_position"], want[key]["position"], 1)

    want = _naive(fact, "search_query")
    for key, row in by(marts_funnel.search_query_performance(funnel), "search_query").items():
        assert (row["impressions"], row["clicks"]) == (want[key]["impressions"], want[key]["clicks"])
        assert (row["unique_visitors"], row["unique_jobs_shown"]) == (want[key]["visitors"], want[key]["jobs"])

    want = _naive(fact.withColumn("hour_of_day", F.hour("search_ts")), "hour_of_day")
    got = by(marts_funnel.hourly_activity(funnel), "hour_of_day")
    assert {k: (r["impressions"], r["unique_visitors"]) for k, r in got.items()} == {
        k: (r["impressions"], r["visitors"]) for k, r in want.items()
    }

    want = _naive(fact.filter("position IS NOT NULL"), "position")
    got = by(marts_funnel.impression_position_ctr(funnel), "page_position")
    assert {k: (r["impressions"], r["clicks"]) for k, r in got.items()} == {
        k: (r["impressions"], r["clicks"]) for k, r in want.items()
    }

    clicked = fact.filter("click_id IS NOT NULL")
    want = _naive(clicked, "opening_uid")
    got = by(marts_funnel.job_click_engagement(funnel), "opening_uid")
    assert {k: (r["total_clicks"], r["unique_clickers"], r["click_time_quantiles"]) for k, r in got.items()} == {
        k: (r["clicks"], r["visitors"], r["quartiles"]) for k, r in want.items()
    }
    got = rows(marts_funnel.search_to_click_conversion(funnel))
    assert sum(r["total_clicks"] for r in got) == clicked.count()
    fact.unpersist()


def test_approximate_counts_stay_within_five_percent(spark):
    silver = tables(
        spark,
        searches=[search(f"g{n}", f"v{n}") for n in range(3000)],
        impressions=[shown(f"i{n}", f"g{n}", f"j{n}") for n in range(3000)],
    )
    exact = rows(marts_funnel.search_query_performance(Funnel(silver)))[0]
    near = rows(marts_funnel.search_query_performance(Funnel(silver), marts_funnel.approximate))[0]
    for name in ("unique_visitors", "unique_jobs_shown", "search_sessions"):
        assert abs(near[name] - exact[name]) <= 0.05 * exact[name]
    assert near["impressions"] == exact["impressions"]


def test_star_fact_takes_the_first_click(market):
    got = by(star.fact_search_events(market), "event_id")
    assert len(got) == 5
    assert got["i1"]["was_clicked"] and got["i1"]["time_to_click_secs"] == 7.0
    assert not got["i3"]["was_clicked"] and got["i3"]["time_to_click_secs"] is None
    assert got["i5"]["event_date"] is None


def test_dim_client_and_calendar(market):
    got = by(star.dim_client(market), "client_uid")
    assert got["c1"]["jobs_posted"] == 1
    day = rows(star.dim_date(market))[0]
    assert (str(day["date_key"]), day["day_of_week"], day["week_of_year"], day["is_weekend"]) == ("2024-01-15", 2, 3, False)


def test_reports_zero_fill_and_name_unknown_clients(market):
    jobs = marts_exact.job_performance(market)
    postings = reports.client_posting_performance(jobs, market.clients)
    got = by(postings, "opening_uid")
    assert (got["j2"]["clicks"], got["j2"]["opportunity_segment"]) == (0, "Active posting needs attention")
    assert got["j1"]["opportunity_segment"] == "Low visibility, strong engagement"
    assert (got["j3"]["company_name"], got["j3"]["opportunity_segment"]) == ("c3", "Steady performance")
    benchmark = reports.client_category_benchmark(jobs, marts_exact.category_performance(market), market.clients)
    chances = by(reports.client_opportunities(postings, benchmark), "opening_uid")
    assert set(chances) == {"j1", "j2"}
    assert chances["j2"]["opportunity_type"] == "Increase visibility"
