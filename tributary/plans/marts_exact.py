"""Gold marts of the first family: exact distinct counts, NULL where nothing was clicked.

Each side of the funnel is reduced to the group key before the two sides are
joined, so only group totals meet in the last join. Impressions are dated by the
time of their search, clicks by their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import count_when, day, percent, places, ratio
from tributary.operators.rollup import same_key, tally, with_ctr
from tributary.plans.silver import SilverTables

JOB_COLUMNS = [
    "opening_uid", "title", "category", "budget_type", "numeric_budget_amount",
    "client_uid", "posted_at", "is_active",
]


def _events() -> Column:
    return F.count("event_id")


def _mean(name: str, digits: int = 1) -> Column:
    return places(F.avg(name), digits)


def _job_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks that belong to a job."""
    return clicks.filter(F.col("opening_uid").isNotNull())


def _search_attribute(silver: SilverTables, name: str) -> DataFrame:
    return silver.searches.select("search_guid", name)


def _shown_by(silver: SilverTables, attribute: DataFrame, name: str) -> DataFrame:
    """Impression side of a mart whose groups are an attribute of the search.

    Impressions are first added up per search and visitor. Visitors and sessions
    are then counted over these few rows (two distinct counts in one group double
    them); only the distinct jobs need the single impressions, and they alone.
    """
    per_search = tally(
        silver.impressions,
        ["search_guid", "visitor_id"],
        events=_events(),
        placed=F.count("position"),
        positions=F.sum("position"),
    )
    visits = tally(
        per_search.join(attribute, "search_guid", "left"),
        name,
        impressions=F.sum("events"),
        unique_visitors=F.countDistinct("visitor_id"),
        search_sessions=F.countDistinct("search_guid"),
        avg_position=places(ratio(F.sum("positions"), F.sum("placed")), 1),
    )
    jobs = tally(
        silver.impressions.select("search_guid", "opening_uid").join(attribute, "search_guid", "left"),
        name,
        unique_jobs=F.countDistinct("opening_uid"),
    )
    return same_key(visits, jobs, name)


def job_performance(silver: SilverTables) -> DataFrame:
    """Funnel of every job, also of jobs that were never shown."""
    shown = tally(
        silver.impressions,
        "opening_uid",
        impressions=_events(),
        unique_visitors_shown=F.countDistinct("visitor_id"),
        avg_impression_position=_mean("position"),
    )
    clicked = tally(
        _job_clicks(silver.clicks),
        "opening_uid",
        clicks=_events(),
        unique_visitors_clicked=F.countDistinct("visitor_id"),
        avg_time_to_click_secs=_mean("time_to_click_secs"),
    )
    # The sketch is kept out of the distinct count, which would shuffle one
    # sketch per (job, visitor) instead of one per job and map task.
    medians = tally(
        _job_clicks(silver.clicks),
        "opening_uid",
        median_time_to_click_secs=places(F.percentile_approx("time_to_click_secs", 0.5), 1),
    )
    # Clicks are joined to the job, not to its impressions: a job may be clicked without any that were kept.
    return (
        silver.jobs.select(*JOB_COLUMNS)
        .join(shown, "opening_uid", "left")
        .join(clicked.join(medians, "opening_uid", "left"), "opening_uid", "left")
        .withColumn("ctr_pct", percent(F.col("clicks"), F.col("impressions")))
        .select(
            *JOB_COLUMNS,
            "impressions",
            "unique_visitors_shown",
            "avg_impression_position",
            "clicks",
            "unique_visitors_clicked",
            "ctr_pct",
            "avg_time_to_click_secs",
            "median_time_to_click_secs",
        )
        .orderBy(F.desc("impressions"), "opening_uid")
    )


def search_query_performance(silver: SilverTables) -> DataFrame:
    """Funnel of every search term."""
    queries = _search_attribute(silver, "search_query")
    shown = _shown_by(silver, queries, "search_query").select(
        "search_query",
        "impressions",
        "unique_visitors",
        F.col("unique_jobs").alias("unique_jobs_shown"),
        "search_sessions",
    )
    clicked = tally(
        _job_clicks(silver.clicks).join(queries.distinct(), "search_guid", "left"),
        "search_query",
        clicks=_events(),
    )
    return with_ctr(shown, clicked, "search_query").orderBy(F.desc("impressions"), "search_query")


def position_ctr(silver: SilverTables) -> DataFrame:
    """Position bias: how clicks fall off down the page."""
    shown = tally(silver.impressions, "position", impressions=_events())
    clicked = tally(
        _job_clicks(silver.clicks),
        "position",
        clicks=_events(),
        avg_time_to_click_secs=_mean("time_to_click_secs"),
    )
    return with_ctr(shown, clicked, "position").orderBy("position")


def category_performance(silver: SilverTables) -> DataFrame:
    """Funnel and budget of every job category.

    Events are counted per job (and visitor) before they meet the job table, so
    a job that holds a large share of the events joins as few rows.
    """
    categories = silver.jobs.select("opening_uid", "category")
    posted = tally(
        silver.jobs,
        "category",
        job_count=F.count("opening_uid"),
        avg_budget_amount=_mean("numeric_budget_amount", 2),
        active_jobs=count_when(F.col("is_active")),
    )
    per_visitor = tally(silver.impressions, ["opening_uid", "visitor_id"], events=_events())
    shown = tally(
        per_visitor.join(categories, "opening_uid", "left"),
        "category",
        impressions=F.sum("events"),
        unique_visitors=F.countDistinct("visitor_id"),
    )
    per_job = tally(_job_clicks(silver.clicks), "opening_uid", events=_events())
    clicked = tally(
        per_job.join(categories, "opening_uid", "left"), "category", clicks=F.sum("events")
    )
    both = posted.join(shown, "category", "left").join(clicked, "category", "left")
    both = both.withColumn("ctr_pct", percent(F.col("clicks"), F.col("impressions")))
    return both.orderBy(F.desc("impressions"), "category")


def sublocation_performance(silver: SilverTables) -> DataFrame:
    """Featured placement against organic results."""
    placement = _search_attribute(silver, "sublocation")
    shown = _shown_by(silver, placement, "sublocation").select(
        "sublocation", "impressions", "unique_visitors", "unique_jobs", "avg_position"
    )
    clicked = tally(
        _job_clicks(silver.clicks).join(placement.distinct(), "search_guid", "left"),
        "sublocation",
        clicks=_events(),
        avg_time_to_click_secs=_mean("time_to_click_secs"),
    )
    return with_ctr(shown, clicked, "sublocation").orderBy("sublocation")


def daily_metrics(silver: SilverTables) -> DataFrame:
    """Funnel per day; all clicks count here, also those without a job."""
    days = silver.searches.select("search_guid", day("event_ts").alias("event_date"))
    shown = _shown_by(silver, days, "event_date").select(
        "event_date",
        "impressions",
        "unique_visitors",
        "search_sessions",
        F.col("unique_jobs").alias("unique_jobs_shown"),
    )
    clicked = tally(
        silver.clicks.withColumn("event_date", day("event_ts")),
        "event_date",
        clicks=_events(),
        avg_time_to_click_secs=_mean("time_to_click_secs"),
    )
    return with_ctr(shown, clicked, "event_date").orderBy("event_date")


MARTS = {
    "p_job_performance": job_performance,
    "p_search_query_performance": search_query_performance,
    "p_position_ctr": position_ctr,
    "p_category_performance": category_performance,
    "p_sublocation_performance": sublocation_performance,
    "p_daily_metrics": daily_metrics,
}
