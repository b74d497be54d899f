"""Business questions as named queries over marts, facts and metric views."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import count_when, percent, places, ratio, zero
from tributary.operators.metric_view import MetricView
from tributary.operators.rollup import tally
from tributary.plans.marts_funnel import Funnel, daily_metrics, searched_between
from tributary.plans.silver import SilverTables

# --- funnel and traffic ------------------------------------------------------


def week_traffic(silver: SilverTables, week_start: str) -> DataFrame:
    """Impressions and clicks of the seven days from `week_start`."""
    cells = Funnel(searched_between(silver, week_start, 7)).cells()
    return cells.agg(zero(F.sum("impressions")).alias("impressions"), zero(F.sum("clicks")).alias("clicks"))


def recent_days(silver: SilverTables, last_day: str, days: int = 30) -> DataFrame:
    """Daily traffic of the last `days` days up to and with `last_day`."""
    first = (date.fromisoformat(last_day) - timedelta(days=days - 1)).isoformat()
    daily = daily_metrics(Funnel(searched_between(silver, first, days)))
    return daily.select("event_date", "impressions", "clicks", "ctr_pct").orderBy("event_date")


def busiest_hour(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy(F.desc("impressions"), "hour_of_day").limit(1)


# --- jobs ----------------------------------------------------------------------


def jobs_by(job_ctr: DataFrame, measure: str, least_impressions: int = 0, rows: int = 10) -> DataFrame:
    """The leading jobs; a rate is asked of jobs that were shown often enough."""
    shown = job_ctr.filter("opening_uid IS NOT NULL").filter(F.col("impressions") >= least_impressions)
    named = shown.select("opening_uid", "title", measure)
    return named.orderBy(F.desc(measure), "opening_uid").limit(rows)


def jobs_at_top(silver: SilverTables, position: int = 3, rows: int = 10) -> DataFrame:
    """Jobs shown most often at the first positions."""
    counts = tally(
        silver.impressions.filter(F.col("position") <= position),
        "opening_uid",
        top_impressions=F.count("event_id"),
    )
    top = counts.orderBy(F.desc("top_impressions"), "opening_uid").limit(rows)
    return (
        top.join(silver.jobs.select("opening_uid", "title"), "opening_uid", "left")
        .select("opening_uid", "title", "top_impressions")
        .orderBy(F.desc("top_impressions"), "opening_uid")
    )


def seen_but_not_clicked(postings: DataFrame, least_impressions: int = 20, low_ctr: float = 2.0) -> DataFrame:
    """Jobs with many impressions and a CTR (percent) below `low_ctr`."""
    chosen = postings.filter((F.col("impressions") >= least_impressions) & (F.col("ctr_pct") < low_ctr))
    return chosen.select("opening_uid", "title", "impressions", "clicks", "ctr_pct")


# --- search terms and categories -----------------------------------------------


def queries_by_clicks(queries: DataFrame) -> DataFrame:
    return queries.select("search_query", "clicks", "impressions").orderBy(F.desc("clicks"), "search_query")


def queries_without_clicks(queries: DataFrame, most_share: float = 0) -> DataFrame:
    """Search terms that led to no click, or to at most that share of all clicks."""
    few = F.col("clicks") == 0
    if most_share:
        few = F.col("clicks") <= most_share * queries.agg(F.sum("clicks")).scalar()
    unclicked = queries.filter(few).select("search_query", "search_sessions")
    return unclicked.orderBy(F.desc("search_sessions"), "search_query")


def queries_by_ctr(queries: DataFrame) -> DataFrame:
    return queries.select("search_query", "ctr_pct").orderBy(F.desc("ctr_pct"), "search_query")


def categories_by_ctr(category: DataFrame) -> DataFrame:
    return category.select("category", "ctr_pct").orderBy(F.desc("ctr_pct"), "category")


def budget_by_category(dim_category: DataFrame) -> DataFrame:
    return dim_category.select("category", "avg_budget_amount").orderBy(F.desc("avg_budget_amount"), "category")


def impressions_per_active_job(category: DataFrame) -> DataFrame:
    per_job = places(ratio(F.col("impressions"), F.col("active_jobs")), 2)
    return category.select("category", per_job.alias("impressions_per_active_job")).orderBy(
        F.desc("impressions_per_active_job"), "category"
    )


# --- placement and position ----------------------------------------------------


def placement(sublocation: DataFrame, measure: str) -> DataFrame:
    return sublocation.select("sublocation", measure).orderBy("sublocation")


def featured_click_speed(sublocation: DataFrame) -> DataFrame:
    """Seconds to click by placement, side by side, and what featured jobs save."""
    sides = sublocation.groupBy().pivot("sublocation", ["featured_jobs", "search_results"])
    wide = sides.agg(F.first("avg_click_time"))
    faster = F.col("search_results") - F.col("featured_jobs")
    return wide.withColumn("featured_faster_secs", places(faster, 1))


def ctr_by_position(position_ctr: DataFrame) -> DataFrame:
    return position_ctr.select("page_position", "ctr_pct").orderBy("page_position")


def click_time_at(position_ctr: DataFrame, positions: list[int]) -> DataFrame:
    chosen = position_ctr.filter(F.col("page_position").isin(*positions))
    return chosen.select("page_position", "avg_click_time").orderBy("page_position")


# --- clients ---------------------------------------------------------------------


def ctr_by(view: MetricView, dimension: str) -> DataFrame:
    """CTR of the metric view by one dimension, best first."""
    rows = view.query([dimension], ["total_impressions", "CTR"])
    return rows.withColumn("CTR", places(F.col("CTR"), 6)).orderBy(F.desc("CTR"), dimension)


def clients_by_jobs_shown(view: MetricView, rows: int = 15) -> DataFrame:
    shown = view.query(["company_name", "opening_uid"], where="source.impression_id IS NOT NULL")
    counts = tally(shown, "company_name", jobs_shown=F.count("opening_uid"))
    return counts.orderBy(F.desc("jobs_shown"), "company_name").limit(rows)


def ctr_spread_in_category(benchmark: DataFrame) -> DataFrame:
    ctr = "client_ctr_pct"
    return tally(
        benchmark,
        "category",
        clients=F.count(ctr),
        lowest_ctr_pct=F.min(ctr),
        highest_ctr_pct=F.max(ctr),
        spread_pct=places(F.max(ctr) - F.min(ctr), 2),
    ).orderBy("category")


def _spend_and_ctr(view: MetricView) -> DataFrame:
    return view.query(["client_uid", "company_name", "numeric_total_spend_usd"], ["CTR"])


def client_spend_vs_ctr(view: MetricView, rows: int = 15) -> DataFrame:
    """The clients who spend most, with their CTR."""
    return (
        _spend_and_ctr(view)
        .filter("numeric_total_spend_usd IS NOT NULL")
        .withColumn("CTR", places(F.col("CTR"), 6))
        .orderBy(F.desc("numeric_total_spend_usd"), "client_uid")
        .limit(rows)
    )


def spend_ctr_correlation(view: MetricView) -> DataFrame:
    return _spend_and_ctr(view).agg(places(F.corr("numeric_total_spend_usd", "CTR"), 6).alias("correlation"))


def clients_at_risk(portfolio: MetricView, low_ctr: float) -> DataFrame:
    """Clients by impressions whose CTR is below `low_ctr` or who got no click at all."""
    rows = portfolio.query(["client_uid", "company_name"], ["total_impressions", "total_clicks", "ctr_pct"])
    at_risk = (F.col("total_impressions") > 0) & ((F.col("ctr_pct") < low_ctr) | (F.col("total_clicks") == 0))
    return rows.filter(at_risk).orderBy(F.desc("total_impressions"), "client_uid")


def demand_against_posting_mix(postings: DataFrame, client_uid) -> DataFrame:
    """Per category: share of all impressions less share of the client's postings.

    The totals are one row of their own; no window brings all categories together.
    """
    own = F.col("client_uid") == F.lit(client_uid)
    per_category = tally(
        postings, "category", impressions=F.sum("impressions"), client_jobs=count_when(own)
    )
    shares = per_category.withColumns(
        {
            "demand_pct": percent(F.col("impressions"), per_category.agg(F.sum("impressions")).scalar()),
            "posting_pct": percent(F.col("client_jobs"), per_category.agg(F.sum("client_jobs")).scalar()),
        }
    )
    mismatch = places(F.coalesce("demand_pct", F.lit(0.0)) - F.coalesce("posting_pct", F.lit(0.0)), 2)
    return shares.withColumn("mismatch_pct", mismatch).orderBy(F.desc("mismatch_pct"), "category")


def weakest_jobs(opportunity_rows: DataFrame, client_uid) -> DataFrame:
    """A client's active jobs, those furthest below their category first."""
    gap = places(F.col("ctr_pct") - F.col("marketplace_ctr_pct"), 2)
    return (
        opportunity_rows.filter(F.col("client_uid") == F.lit(client_uid))
        .select(
            "opening_uid",
            "title",
            "category",
            "ctr_pct",
            "marketplace_ctr_pct",
            gap.alias("gap_pct"),
            "opportunity_type",
            "recommended_action",
        )
        .orderBy(F.asc_nulls_last("gap_pct"), "opening_uid")
    )


def client_gaps(benchmark: DataFrame, client_uid) -> DataFrame:
    return (
        benchmark.filter(F.col("client_uid") == F.lit(client_uid))
        .select(
            "category",
            "client_ctr_pct",
            "marketplace_ctr_pct",
            "ctr_gap_pct",
            "client_avg_budget_amount",
            "marketplace_avg_budget_amount",
            "budget_gap_amount",
        )
        .orderBy("category")
    )


# --- freelancers -----------------------------------------------------------------


def _per_freelancer(fact: DataFrame, dim_freelancer: DataFrame) -> DataFrame:
    """Each visitor's counts, added up before the profiles are joined."""
    counts = tally(
        fact,
        "visitor_id",
        impressions=F.count("event_id"),
        clicked=count_when(F.col("was_clicked")),
        times=F.count("time_to_click_secs"),
        time_total=F.sum("time_to_click_secs"),
    )
    profiles = dim_freelancer.select("visitor_id", "top_rated", "numeric_hourly_rate")
    return counts.join(profiles, "visitor_id", "left")


def _behaviour(df: DataFrame, by: str) -> DataFrame:
    return tally(
        df,
        by,
        visitors=F.count("visitor_id"),
        impressions=F.sum("impressions"),
        ctr_pct=percent(F.sum("clicked"), F.sum("impressions")),
        avg_time_to_click_secs=places(ratio(F.sum("time_total"), F.sum("times")), 2),
    ).orderBy(by)


def click_speed_of_top_rated(fact: DataFrame, dim_freelancer: DataFrame) -> DataFrame:
    return _behaviour(_per_freelancer(fact, dim_freelancer), "top_rated")


def behaviour_by_hourly_rate(fact: DataFrame, dim_freelancer: DataFrame, step: int = 10) -> DataFrame:
    """Search behaviour by band of hourly rate; each band is named by its lower bound."""
    band = (F.floor(F.col("numeric_hourly_rate") / step) * step).cast("int")
    rows = _per_freelancer(fact, dim_freelancer).withColumn("rate_from", band)
    return _behaviour(rows, "rate_from")
