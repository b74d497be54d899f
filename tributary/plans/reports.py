"""Report views for account management, over the per-job and per-category marts.

The per-job mart holds every job once with its attributes, so the reports read it
alone instead of joining it to the job table again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.labels import opportunity_type, posting_labels
from tributary.functions.scalars import count_when, places, ratio, zero
from tributary.operators.rollup import tally


def _named(df: DataFrame, clients: DataFrame) -> DataFrame:
    """Add `company_name`; a client without a profile is shown by its key."""
    names = clients.select("client_uid", F.col("company_name").alias("_name"))
    name = F.coalesce("_name", F.col("client_uid").cast("string"))
    return df.join(names, "client_uid", "left").withColumn("company_name", name).drop("_name")


def client_posting_performance(job_performance: DataFrame, clients: DataFrame) -> DataFrame:
    """Every posting with zero-filled funnel counts, its segment and an action."""
    impressions = zero(F.col("impressions"))
    clicks = zero(F.col("clicks"))
    ctr = zero(F.col("ctr_pct"))
    segment, action = posting_labels(impressions, clicks, ctr, F.col("is_active"))
    return _named(job_performance, clients).select(
        "client_uid",
        "company_name",
        "opening_uid",
        "title",
        "category",
        "budget_type",
        places(F.col("numeric_budget_amount"), 2).alias("budget_amount"),
        "is_active",
        impressions.alias("impressions"),
        clicks.alias("clicks"),
        places(ctr, 2).alias("ctr_pct"),
        places(F.col("avg_impression_position"), 1).alias("avg_impression_position"),
        places(F.col("avg_time_to_click_secs"), 1).alias("avg_time_to_click_secs"),
        segment.alias("opportunity_segment"),
        action.alias("recommended_action"),
    )


def client_category_benchmark(
    job_performance: DataFrame, category_performance: DataFrame, clients: DataFrame
) -> DataFrame:
    """Each client's results per category beside the whole marketplace."""
    own = tally(
        job_performance,
        ["client_uid", "category"],
        client_jobs=F.countDistinct("opening_uid"),
        client_active_jobs=count_when(F.col("is_active")),
        client_impressions=F.sum(zero(F.col("impressions"))),
        client_clicks=F.sum(zero(F.col("clicks"))),
        client_budget=F.avg("numeric_budget_amount"),
    ).withColumn("client_ctr", ratio(F.col("client_clicks"), F.col("client_impressions")) * 100)
    market = category_performance.select(
        "category",
        F.col("impressions").alias("marketplace_impressions"),
        F.col("clicks").alias("marketplace_clicks"),
        F.col("ctr_pct").alias("market_ctr"),
        F.col("avg_budget_amount").alias("market_budget"),
    )
    return _named(own.join(market, "category", "left"), clients).select(
        "client_uid",
        "company_name",
        "category",
        "client_jobs",
        "client_active_jobs",
        "client_impressions",
        "client_clicks",
        places(F.col("client_ctr"), 2).alias("client_ctr_pct"),
        places(F.col("client_budget"), 2).alias("client_avg_budget_amount"),
        "marketplace_impressions",
        "marketplace_clicks",
        places(F.col("market_ctr"), 2).alias("marketplace_ctr_pct"),
        places(F.col("market_budget"), 2).alias("marketplace_avg_budget_amount"),
        places(F.col("client_ctr") - F.col("market_ctr"), 2).alias("ctr_gap_pct"),
        places(F.col("client_budget") - F.col("market_budget"), 2).alias("budget_gap_amount"),
    )


def client_opportunities(postings: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Active postings with the lever that promises most."""
    market = benchmark.select(
        "client_uid", "category", "marketplace_ctr_pct", "marketplace_avg_budget_amount"
    )
    lever = opportunity_type(
        F.col("impressions"),
        F.col("ctr_pct"),
        F.col("budget_amount"),
        F.col("marketplace_ctr_pct"),
        F.col("marketplace_avg_budget_amount"),
    )
    return (
        postings.filter("is_active")
        .join(market, ["client_uid", "category"], "left")
        .select(
            "client_uid",
            "company_name",
            "opening_uid",
            "title",
            "category",
            "is_active",
            "impressions",
            "clicks",
            "ctr_pct",
            "budget_amount",
            "marketplace_ctr_pct",
            "marketplace_avg_budget_amount",
            lever.alias("opportunity_type"),
            "recommended_action",
        )
        .orderBy(F.desc("impressions"), "ctr_pct", "opening_uid")
    )
