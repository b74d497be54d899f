"""The tiles of the three dashboards, as queries over the marts.

A top-k tile ends its sort with the key, so equal values have a fixed order;
`orderBy().limit()` is planned as a top-k per task, not as a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.labels import latency_bucket
from tributary.functions.scalars import percent, places
from tributary.operators.rollup import tally
from tributary.plans import semantic


def _overall_ctr():
    return percent(F.sum("clicks"), F.sum("impressions"))


# --- marketplace insights ----------------------------------------------------


def funnel_summary(job_ctr: DataFrame) -> DataFrame:
    return job_ctr.agg(
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        _overall_ctr().alias("overall_ctr_pct"),
        F.countDistinct("opening_uid").alias("jobs_in_results"),
    )


def _job_board(job_ctr: DataFrame, jobs: DataFrame, *extra: str) -> DataFrame:
    attributes = jobs.select("opening_uid", "category", "budget_type", "numeric_budget_amount")
    return job_ctr.join(attributes, "opening_uid", "left").select(
        "opening_uid",
        "title",
        "category",
        "budget_type",
        "numeric_budget_amount",
        "impressions",
        "clicks",
        "ctr_pct",
        "avg_impression_position",
        *extra,
    )


def top_jobs_by_impressions(job_ctr: DataFrame, jobs: DataFrame) -> DataFrame:
    top = job_ctr.filter("impressions IS NOT NULL").orderBy(F.desc("impressions"), "opening_uid").limit(10)
    return _job_board(top, jobs, "avg_click_time").orderBy(F.desc("impressions"), "opening_uid")


def top_jobs_by_ctr(job_ctr: DataFrame, jobs: DataFrame) -> DataFrame:
    top = job_ctr.filter("impressions >= 5").orderBy(F.desc("ctr_pct"), "opening_uid").limit(10)
    return _job_board(top, jobs).orderBy(F.desc("ctr_pct"), "opening_uid")


def position_bias(position_ctr: DataFrame) -> DataFrame:
    return (
        position_ctr.filter("page_position <= 20")
        .select("page_position", "impressions", "avg_click_time")
        .orderBy("page_position")
    )


def category_performance(category: DataFrame) -> DataFrame:
    return (
        category.filter("category IS NOT NULL")
        .select(
            "category",
            "job_count",
            "active_jobs",
            places(F.col("avg_budget"), 0).alias("avg_budget"),
            "impressions",
            "unique_visitors",
            "clicks",
            "ctr_pct",
        )
        .orderBy(F.desc("impressions"), "category")
    )


def category_ctr_vs_budget(category: DataFrame) -> DataFrame:
    return category.filter("category IS NOT NULL AND avg_budget IS NOT NULL").select(
        "category", places(F.col("avg_budget"), 0).alias("avg_budget"), "ctr_pct", "impressions"
    )


def search_query_performance(queries: DataFrame) -> DataFrame:
    return (
        queries.filter("search_query IS NOT NULL")
        .select(
            "search_query",
            "search_sessions",
            "unique_visitors",
            "unique_jobs_shown",
            "impressions",
            "clicks",
            "ctr_pct",
        )
        .orderBy(F.desc("impressions"), "search_query")
        .limit(20)
    )


def sublocation_performance(sublocation: DataFrame) -> DataFrame:
    return sublocation.select(
        "sublocation",
        "impressions",
        "unique_visitors",
        "unique_jobs",
        "avg_position",
        "clicks",
        "ctr_pct",
        "avg_click_time",
    ).orderBy("sublocation")


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select(
        "event_date",
        "impressions",
        "unique_visitors",
        "search_sessions",
        "unique_jobs_shown",
        "clicks",
        "ctr_pct",
        "avg_click_time",
    ).orderBy("event_date")


def time_to_click(clicks: DataFrame) -> DataFrame:
    return tally(
        clicks.withColumn("latency_bucket", latency_bucket(F.col("time_to_click_secs"))),
        "latency_bucket",
        clicks=F.count(F.lit(1)),
        avg_secs=places(F.avg("time_to_click_secs"), 1),
    )


def budget_type_distribution(job_ctr: DataFrame, jobs: DataFrame) -> DataFrame:
    counts = job_ctr.select("opening_uid", "impressions", "clicks")
    return tally(
        jobs.filter("budget_type IS NOT NULL").join(counts, "opening_uid", "left"),
        "budget_type",
        job_count=F.count(F.lit(1)),
        avg_budget_amount=places(F.avg("numeric_budget_amount"), 2),
        total_impressions=F.sum("impressions"),
        ctr_pct=_overall_ctr(),
    ).orderBy(F.desc("job_count"), "budget_type")


def client_activity(job_ctr: DataFrame, jobs: DataFrame) -> DataFrame:
    counts = job_ctr.select("opening_uid", "impressions", "clicks")
    return (
        tally(
            jobs.join(counts, "opening_uid", "left"),
            "client_uid",
            jobs_posted=F.countDistinct("opening_uid"),
            total_impressions=F.sum("impressions"),
            total_clicks=F.sum("clicks"),
            avg_ctr_pct=_overall_ctr(),
            avg_budget_amount=places(F.avg("numeric_budget_amount"), 2),
        )
        .orderBy(F.desc("total_impressions"), "client_uid")
        .limit(15)
    )


# --- client demand -----------------------------------------------------------


def portfolio_overview(postings: DataFrame) -> DataFrame:
    measures = ["clients_tracked", "jobs_posted", "total_impressions", "ctr_pct"]
    overall = semantic.client_portfolio_view(postings).query(measures=measures)
    return overall.withColumnsRenamed({"jobs_posted": "total_jobs_posted", "ctr_pct": "avg_ctr_pct"})


def top_accounts(postings: DataFrame) -> DataFrame:
    measures = [
        "active_jobs", "total_impressions", "total_clicks", "ctr_pct", "avg_budget_amount", "unique_categories",
    ]
    accounts = semantic.client_portfolio_view(postings).query(["company_name"], measures)
    return accounts.orderBy(F.desc("total_impressions"), "company_name").limit(15)


def posting_watchlist(postings: DataFrame) -> DataFrame:
    return (
        postings.filter("is_active")
        .orderBy(F.desc("impressions"), "ctr_pct", "opening_uid")
        .limit(20)
        .select(
            "opening_uid",
            "company_name",
            "title",
            "category",
            "impressions",
            "clicks",
            "ctr_pct",
            "opportunity_segment",
            "recommended_action",
        )
    )


def category_benchmark(benchmark: DataFrame) -> DataFrame:
    return (
        benchmark.filter("client_impressions IS NOT NULL")
        .orderBy(F.abs("ctr_gap_pct").desc_nulls_last(), "client_uid", "category")
        .limit(20)
        .select(
            "client_uid",
            "company_name",
            "category",
            "client_active_jobs",
            "client_impressions",
            "client_ctr_pct",
            "marketplace_ctr_pct",
            "ctr_gap_pct",
            "client_avg_budget_amount",
            "marketplace_avg_budget_amount",
            "budget_gap_amount",
        )
    )


def opportunities(opportunity_rows: DataFrame) -> DataFrame:
    return (
        opportunity_rows.orderBy(F.desc("impressions"), "ctr_pct", "opening_uid")
        .limit(20)
        .select(
            "opening_uid",
            "company_name",
            "title",
            "category",
            "impressions",
            "ctr_pct",
            "opportunity_type",
            "recommended_action",
        )
    )


def marketplace_snapshot(postings: DataFrame) -> DataFrame:
    measures = ["impressions", "clicks", "ctr_pct", "avg_budget_amount"]
    snapshot = semantic.category_view(postings).query(["category"], measures)
    return snapshot.orderBy(F.desc("impressions"), "category").limit(15)


def client_picker(clients: DataFrame) -> DataFrame:
    return clients.select("client_uid", "company_name").orderBy("company_name", "client_uid")
