"""Star schema: one fact per impression and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import day, places
from tributary.operators.keyed import first_per_key, join_grouped
from tributary.operators.rollup import tally
from tributary.plans.marts_exact import JOB_COLUMNS
from tributary.plans.silver import SilverTables

CLIENT_COLUMNS = [
    "client_uid", "company_name", "country", "industry", "payment_verified",
    "numeric_total_spend_usd", "avg_rating",
]
FREELANCER_COLUMNS = [
    "visitor_id", "name", "country", "primary_skill", "numeric_hourly_rate",
    "numeric_job_success_score", "member_since", "top_rated", "is_verified",
]
CLICK_KEYS = ["visitor_id", "opening_uid", "search_guid"]
SEARCH_COLUMNS = ["search_guid", "visitor_id", "search_query", "sublocation", "sort", "page", "event_ts"]


def dim_job(silver: SilverTables) -> DataFrame:
    return silver.jobs.select(*JOB_COLUMNS)


def dim_client(silver: SilverTables) -> DataFrame:
    """Client profile and posting activity; NULL activity for a client without postings."""
    activity = tally(
        silver.jobs,
        "client_uid",
        jobs_posted=F.count("opening_uid"),
        first_posted_at=F.min("posted_at"),
        latest_posted_at=F.max("posted_at"),
    )
    return silver.clients.select(*CLIENT_COLUMNS).join(activity, "client_uid", "left")


def dim_category(silver: SilverTables) -> DataFrame:
    return tally(
        silver.jobs,
        "category",
        total_jobs=F.count("opening_uid"),
        avg_budget_amount=places(F.avg("numeric_budget_amount"), 2),
    )


def dim_freelancer(silver: SilverTables) -> DataFrame:
    return silver.freelancers.select(*FREELANCER_COLUMNS)


def dim_date(silver: SilverTables) -> DataFrame:
    """Calendar of the days on which somebody searched; Sunday is day 1."""
    key = F.col("date_key")
    parts = {
        "year": F.year,
        "quarter": F.quarter,
        "month": F.month,
        "day_of_month": F.dayofmonth,
        "day_of_week": F.dayofweek,
        "week_of_year": F.weekofyear,
    }
    days = silver.searches.select(day("event_ts").alias("date_key")).distinct()
    calendar = days.withColumns({name: part(key) for name, part in parts.items()})
    return calendar.withColumn("is_weekend", F.col("day_of_week").isin(1, 7)).orderBy("date_key")


def dim_search(silver: SilverTables) -> DataFrame:
    return silver.searches.select(*SEARCH_COLUMNS)


def first_clicks(silver: SilverTables) -> DataFrame:
    """The earliest click per visitor, job and search."""
    clicks = silver.clicks.filter("opening_uid IS NOT NULL").select(
        *CLICK_KEYS, "time_to_click_secs", "event_ts", "event_id"
    )
    order = [F.col("event_ts").asc_nulls_last(), F.col("event_id").asc_nulls_last()]
    return first_per_key(clicks, CLICK_KEYS, order).select(
        *CLICK_KEYS, "time_to_click_secs", F.lit(True).alias("matched")
    )


def impression_outcomes(silver: SilverTables) -> DataFrame:
    """One row per impression with the outcome of its first click, without its search."""
    impressions = silver.impressions.select("event_id", *CLICK_KEYS)
    return join_grouped(impressions, first_clicks(silver), CLICK_KEYS).select(
        "event_id", "visitor_id", F.col("matched").isNotNull().alias("was_clicked"), "time_to_click_secs"
    )


def fact_search_events(silver: SilverTables) -> DataFrame:
    """One row per impression with its search and the outcome of its first click."""
    impressions = silver.impressions.select(
        "event_id", "opening_uid", "visitor_id", "search_guid", "position", "collector_ts"
    )
    searches = silver.searches.select("search_guid", "search_query", "sublocation", "event_ts")
    enriched = impressions.join(searches, "search_guid", "left")
    return join_grouped(enriched, first_clicks(silver), CLICK_KEYS).select(
        "event_id",
        day("event_ts").alias("event_date"),
        "opening_uid",
        "visitor_id",
        "search_guid",
        "search_query",
        "position",
        "sublocation",
        "event_ts",
        "collector_ts",
        F.col("matched").isNotNull().alias("was_clicked"),
        "time_to_click_secs",
    )


TABLES = {
    "dim_job": dim_job,
    "dim_client": dim_client,
    "dim_category": dim_category,
    "dim_freelancer": dim_freelancer,
    "dim_date": dim_date,
    "dim_search": dim_search,
    "fact_search_events": fact_search_events,
}
