"""Gold marts of the second family, built on the search funnel.

The funnel keeps every search, attaches its impressions, and attaches the clicks
of the same search and job. A job shown n times and clicked m times in one
search gives n * m funnel rows. `funnel_fact` returns these rows; the marts never
build them. They work on *cells*, one row per search and job with the number of
funnel rows it stands for, and take all counts that depend on the search alone
(visitors, sessions) from the searches themselves.

Distinct counts are exact or approximate: each mart takes `distinct`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import count_when, day, percent, places, ratio, zero
from tributary.operators.quantiles import weighted_quantiles
from tributary.operators.rollup import same_key, tally
from tributary.plans.silver import SilverTables
from tributary.session import kept

Distinct = Callable[[str], Column]
exact: Distinct = F.countDistinct
approximate: Distinct = F.approx_count_distinct

PAIR = ["search_guid", "opening_uid"]
QUARTILES = [0.25, 0.5, 0.75]

JOB_DIMENSION = [
    "opening_uid", "client_uid", "title", "category", "budget_type", "numeric_budget_amount",
    "is_active", "posted_at",
]
CLIENT_DIMENSION = [
    "client_uid", "company_name", "industry", "payment_verified", "avg_rating", "numeric_total_spend_usd",
]
FREELANCER_DIMENSION = [
    "visitor_id", "name", "country", "primary_skill", "member_since", "top_rated", "is_verified",
    "numeric_hourly_rate", "numeric_job_success_score",
]


def dim_job_openings(silver: SilverTables) -> DataFrame:
    return silver.jobs.select(*JOB_DIMENSION)


def dim_clients(silver: SilverTables) -> DataFrame:
    return silver.clients.select(*CLIENT_DIMENSION)


def dim_freelancers(silver: SilverTables) -> DataFrame:
    return silver.freelancers.select(*FREELANCER_DIMENSION)


def _search_side(silver: SilverTables) -> DataFrame:
    return silver.searches.select(
        "search_guid", "visitor_id", "search_query", "sublocation", F.col("event_ts").alias("search_ts")
    )


def searched_between(silver: SilverTables, first_day: str, days: int) -> SilverTables:
    """The silver tables of the searches of some days.

    A plain range of the search time, which reaches the scan of a stored table; events of other
    searches are dropped before anything is added up.
    """
    kind = silver.searches.schema["event_ts"].dataType
    end = (date.fromisoformat(first_day) + timedelta(days=days)).isoformat()
    searches = silver.searches.filter((F.col("event_ts") >= F.lit(first_day).cast(kind)) & (F.col("event_ts") < F.lit(end).cast(kind)))
    own = searches.select("search_guid")
    return SilverTables(
        searches,
        silver.impressions.join(own, "search_guid", "left_semi"),
        silver.clicks.join(own, "search_guid", "left_semi"),
        silver.jobs,
        silver.clients,
        silver.freelancers,
    )


def unshown_searches(silver: SilverTables) -> DataFrame:
    """Searches without any impression."""
    shown = silver.impressions.select("search_guid").distinct()
    return _search_side(silver).join(shown, "search_guid", "left_anti")


def funnel_fact(silver: SilverTables) -> DataFrame:
    """The funnel rows: every search, its impressions, their clicks.

    Written as an inner join plus the searches without impressions instead of a
    left join from searches: the large side of an inner join can be split when
    one search holds a great share of the impressions, the right side of a left
    join cannot.
    """
    impressions = silver.impressions.select(
        *PAIR, F.col("event_id").alias("impression_id"), "position"
    )
    clicks = silver.clicks.select(*PAIR, F.col("event_id").alias("click_id"), "time_to_click_secs")
    shown = impressions.join(clicks, PAIR, "left").join(_search_side(silver), "search_guid")
    columns = [
        "search_guid", "visitor_id", "search_query", "sublocation", "search_ts", "impression_id",
        "opening_uid", "position", "click_id", "time_to_click_secs",
    ]
    return shown.select(*columns).unionByName(unshown_searches(silver), allowMissingColumns=True)


def _click_totals(silver: SilverTables, by_time: bool = False) -> DataFrame:
    grain = [*PAIR, "time_to_click_secs"] if by_time else PAIR
    return tally(
        silver.clicks,
        grain,
        click_rows=F.count(F.lit(1)),
        click_ids=F.count("event_id"),
        times=F.count("time_to_click_secs"),
        time_total=F.sum("time_to_click_secs"),
    )


class Funnel:
    """Funnel rows of shown searches, added up per search and job.

    In a cell, `impressions` and `clicks` count the funnel rows with an impression
    id or a click id, `rows` all of them; `position_total` and `time_total` are
    sums over the funnel rows, `times` the rows with a click time. With `by_time`
    there is a cell per distinct click time, with `by_position` one per position.

    A run that builds all marts stores the cells once and passes them as `stored`.
    """

    def __init__(self, silver: SilverTables, stored: DataFrame | None = None):
        self.silver = silver
        self.stored = stored

    def cells(self, by_time: bool = False, by_position: bool = False) -> DataFrame:
        if self.stored is not None:
            return self.stored
        shown = tally(
            self.silver.impressions,
            [*PAIR, "position"] if by_position else PAIR,
            shown_rows=F.count(F.lit(1)),
            shown_ids=F.count("event_id"),
            positions=F.sum(F.col("position").cast("bigint")),
        )
        clicked = _click_totals(self.silver, by_time)
        copies = F.coalesce(F.col("click_rows"), F.lit(1))
        joined = shown.join(clicked, PAIR, "left").select(
            *PAIR,
            (F.col("shown_rows") * copies).alias("rows"),
            (F.col("shown_ids") * copies).alias("impressions"),
            (F.col("positions") * copies).alias("position_total"),
            (F.col("shown_rows") * zero(F.col("click_ids"))).alias("clicks"),
            (F.col("shown_rows") * zero(F.col("times"))).alias("times"),
            (F.col("shown_rows") * F.col("time_total")).alias("time_total"),
            *(["time_to_click_secs"] if by_time else []),
            *(["position"] if by_position else []),
        )
        return joined.join(_search_side(self.silver), "search_guid")

    def with_unshown(self, cells: DataFrame) -> DataFrame:
        """The cells, and a row without impressions for every search that showed nothing."""
        none = F.lit(0).cast("bigint")
        unshown = unshown_searches(self.silver).select("*", none.alias("impressions"), none.alias("clicks"))
        return cells.unionByName(unshown, allowMissingColumns=True)

    def clicked(self) -> DataFrame:
        """Cells with a click, one per distinct click time.

        `times` counts the funnel rows with a click time, `clicks` those with a
        click id, `timed_clicks` those with both. All joins are inner, so only
        pairs that were clicked travel.
        """
        if self.stored is not None:
            found = self.stored.filter("clicks > 0 OR times > 0")
        else:
            clicked = _click_totals(self.silver, by_time=True)
            shown = tally(self.silver.impressions, PAIR, shown_rows=F.count(F.lit(1)))
            found = (
                clicked.join(shown, PAIR)
                .withColumn("clicks", F.col("shown_rows") * F.col("click_ids"))
                .withColumn("times", F.col("shown_rows") * F.col("times"))
                .join(_search_side(self.silver), "search_guid")
            )
        timed = F.col("time_to_click_secs").isNotNull()
        return found.select(
            *PAIR,
            "visitor_id",
            "search_query",
            "sublocation",
            "time_to_click_secs",
            "clicks",
            "times",
            F.when(timed, F.col("clicks")).otherwise(0).alias("timed_clicks"),
        )


def quartiles_of(times: DataFrame, by: str, weight: str) -> DataFrame:
    """Exact quartiles of the click time per group, as `click_time_quantiles`."""
    return weighted_quantiles(times, by, "time_to_click_secs", F.col(weight), QUARTILES, "click_time_quantiles")


def _visitor_sketches() -> dict[str, Column]:
    """Mergeable sketches of who saw and who clicked."""
    visitor = F.col("visitor_id").cast("string")
    return {"seen_by": F.hll_sketch_agg(visitor), "clicked_by": F.hll_sketch_agg(F.when(F.col("clicks") > 0, visitor))}


def _mean_time(digits: int) -> Column:
    return places(ratio(F.sum("time_total"), F.sum("times")), digits)


def _mean_click_time(digits: int) -> Column:
    """Mean click time over rows of `Funnel.clicked` that have a click id."""
    total = F.sum(F.col("timed_clicks") * F.col("time_to_click_secs"))
    return places(ratio(total, F.sum("timed_clicks")), digits)


def _mean_position() -> Column:
    return places(ratio(F.sum("position_total"), F.sum("rows")), 1)


def _counts() -> dict[str, Column]:
    return {"impressions": F.sum("impressions"), "clicks": F.sum("clicks")}


def _zero_filled(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: zero(F.col(n)) for n in names})


def _with_ctr(df: DataFrame) -> DataFrame:
    return df.withColumn("ctr_pct", percent(F.col("clicks"), F.col("impressions")))


def job_performance_ctr(funnel: Funnel, distinct: Distinct = exact, quartiles: bool = True) -> DataFrame:
    """Funnel of every job shown; the NULL job stands for searches that showed none.

    Without `quartiles` their column is left out, and with it the work for it.
    """
    sums = {**_counts(), **{n: F.sum(n) for n in ("rows", "position_total", "times", "time_total")}}
    cells = funnel.cells(by_time=quartiles)
    grain = ["opening_uid", "visitor_id"] if distinct is exact else ["opening_uid"]
    if quartiles:
        # Counts and quartiles start from one stored roll-up, so events are read and joined once.
        timed = [*grain, "time_to_click_secs"]
        cells = times = kept(tally(cells, timed, **sums, **({} if distinct is exact else _visitor_sketches())), "click-times")
    if distinct is exact:
        # One row per job and visitor makes both distinct counts plain counts.
        cells = tally(cells, grain, **sums)
        visitors = F.count("visitor_id")
        clickers = F.count(F.when(F.col("clicks") > 0, F.col("visitor_id")))
    elif quartiles:
        visitors, clickers = (F.hll_sketch_estimate(F.hll_union_agg(n)) for n in ("seen_by", "clicked_by"))
    else:
        visitors = distinct("visitor_id")
        clickers = distinct(F.when(F.col("clicks") > 0, F.col("visitor_id")))
    shown = tally(
        cells,
        "opening_uid",
        impressions=F.sum("impressions"),
        unique_impression_visitors=visitors,
        avg_impression_position=_mean_position(),
        clicks=F.sum("clicks"),
        unique_click_visitors=clickers,
        avg_click_time=_mean_time(1),
    )
    if quartiles:
        shown = shown.join(quartiles_of(times, "opening_uid", "times"), "opening_uid", "left")
    jobs = dim_job_openings(funnel.silver).select("opening_uid", "title", "client_uid")
    no_job = tally(
        unshown_searches(funnel.silver).withColumn("opening_uid", F.lit(None).cast(jobs.schema[0].dataType)),
        "opening_uid",
        impressions=F.lit(0).cast("bigint"),
        unique_impression_visitors=distinct("visitor_id"),
        clicks=F.lit(0).cast("bigint"),
        unique_click_visitors=F.lit(0).cast("bigint"),
    )
    per_job = shown.join(jobs, "opening_uid", "left")
    return _with_ctr(per_job.unionByName(no_job, allowMissingColumns=True)).select(
        "opening_uid",
        "title",
        "client_uid",
        "impressions",
        "unique_impression_visitors",
        "avg_impression_position",
        "clicks",
        "unique_click_visitors",
        "avg_click_time",
        *(["click_time_quantiles"] if quartiles else []),
        "ctr_pct",
    )


def impression_position_ctr(funnel: Funnel) -> DataFrame:
    """Position bias over the funnel."""
    per_position = tally(
        funnel.cells(by_position=True).filter("position IS NOT NULL"),
        F.col("position").alias("page_position"),
        avg_click_time=_mean_time(1),
        **_counts(),
    )
    return (
        _with_ctr(per_position)
        .select("page_position", "impressions", "clicks", "ctr_pct", "avg_click_time")
        .orderBy("page_position")
    )


def search_query_performance(funnel: Funnel, distinct: Distinct = exact) -> DataFrame:
    """Funnel of every search term; a term that never showed a job has zeros."""
    searched = tally(
        funnel.silver.searches.filter("search_query IS NOT NULL"),
        "search_query",
        unique_visitors=distinct("visitor_id"),
        search_sessions=distinct("search_guid"),
    )
    shown = tally(funnel.cells(), "search_query", unique_jobs_shown=distinct("opening_uid"), **_counts())
    joined = searched.join(shown, "search_query", "left")
    return (
        _with_ctr(_zero_filled(joined, "impressions", "clicks", "unique_jobs_shown"))
        .select(
            "search_query",
            "impressions",
            "unique_visitors",
            "unique_jobs_shown",
            "search_sessions",
            "clicks",
            "ctr_pct",
        )
        .orderBy(F.desc("impressions"), "search_query")
    )


def category_performance(funnel: Funnel, distinct: Distinct = exact) -> DataFrame:
    """Funnel of every job category, joined per job and visitor, not per event."""
    jobs = dim_job_openings(funnel.silver)
    posted = tally(
        jobs,
        "category",
        job_count=F.count("opening_uid"),
        avg_budget=places(F.avg("numeric_budget_amount"), 2),
        active_jobs=count_when(F.col("is_active")),
    )
    per_visitor = tally(funnel.cells(), ["opening_uid", "visitor_id"], **_counts())
    shown = tally(
        per_visitor.join(jobs.select("opening_uid", "category"), "opening_uid", "left"),
        "category",
        unique_visitors=distinct("visitor_id"),
        **_counts(),
    )
    return (
        _with_ctr(posted.join(shown, "category", "left"))
        .select(
            "category",
            "job_count",
            "avg_budget",
            "active_jobs",
            "impressions",
            "unique_visitors",
            "clicks",
            "ctr_pct",
        )
        .orderBy(F.desc("impressions"), "category")
    )


def sublocation_performance(funnel: Funnel, distinct: Distinct = exact) -> DataFrame:
    """Featured placement against organic results."""
    searched = tally(
        funnel.silver.searches.filter("sublocation IS NOT NULL"),
        "sublocation",
        unique_visitors=distinct("visitor_id"),
    )
    shown = tally(
        funnel.cells(),
        "sublocation",
        unique_jobs=distinct("opening_uid"),
        avg_position=_mean_position(),
        avg_click_time=_mean_time(1),
        **_counts(),
    )
    joined = searched.join(shown, "sublocation", "left")
    return (
        _with_ctr(_zero_filled(joined, "impressions", "clicks", "unique_jobs"))
        .select(
            "sublocation",
            "impressions",
            "unique_visitors",
            "unique_jobs",
            "avg_position",
            "clicks",
            "avg_click_time",
            "ctr_pct",
        )
        .orderBy("sublocation")
    )


def daily_metrics(funnel: Funnel, distinct: Distinct = exact) -> DataFrame:
    """Funnel per day; clicks are dated by the time of their search."""
    searched = tally(
        funnel.silver.searches.withColumn("event_date", day("event_ts")),
        "event_date",
        unique_visitors=distinct("visitor_id"),
        search_sessions=distinct("search_guid"),
    )
    shown = tally(
        funnel.cells().withColumn("event_date", day("search_ts")),
        "event_date",
        unique_jobs_shown=distinct("opening_uid"),
        avg_click_time=_mean_time(1),
        **_counts(),
    )
    joined = same_key(searched, shown, "event_date")
    return (
        _with_ctr(_zero_filled(joined, "impressions", "clicks", "unique_jobs_shown"))
        .select(
            "event_date",
            "impressions",
            "unique_visitors",
            "search_sessions",
            "unique_jobs_shown",
            "clicks",
            "avg_click_time",
            "ctr_pct",
        )
        .orderBy("event_date")
    )


def visitor_engagement(funnel: Funnel, distinct: Distinct = exact) -> DataFrame:
    """What every visitor searched and saw."""
    searched = tally(funnel.silver.searches, "visitor_id", total_searches=distinct("search_guid"))
    seen = tally(
        funnel.cells(),
        "visitor_id",
        total_impressions=F.sum("impressions"),
        unique_jobs_seen=distinct("opening_uid"),
    )
    joined = same_key(searched, seen, "visitor_id")
    return _zero_filled(joined, "total_impressions", "unique_jobs_seen").select(
        "visitor_id", "total_impressions", "total_searches", "unique_jobs_seen"
    )


def job_click_engagement(funnel: Funnel, distinct: Distinct = exact) -> DataFrame:
    """Click depth of every clicked job."""
    # As above: one stored roll-up for counts and quartiles.
    grain = ["opening_uid", "visitor_id", "time_to_click_secs"]
    clicked = tally(funnel.clicked().filter("clicks > 0"), grain, clicks=F.sum("clicks"), timed_clicks=F.sum("timed_clicks"))
    clicked = kept(clicked, "click-times")
    totals = tally(
        clicked,
        "opening_uid",
        total_clicks=F.sum("clicks"),
        unique_clickers=distinct("visitor_id"),
        avg_time_to_click=_mean_click_time(2),
    )
    return totals.join(quartiles_of(clicked, "opening_uid", "timed_clicks"), "opening_uid", "left")


def search_to_click_conversion(funnel: Funnel) -> DataFrame:
    """Which terms and placements lead to clicks."""
    return tally(
        funnel.clicked().filter("clicks > 0"),
        ["search_query", "sublocation"],
        searches_with_clicks=F.countDistinct("search_guid"),
        total_clicks=F.sum("clicks"),
        avg_time_to_click=_mean_click_time(2),
    )


def hourly_activity(funnel: Funnel, distinct: Distinct = exact) -> DataFrame:
    """Traffic by hour of the day."""
    searched = tally(
        funnel.silver.searches.withColumn("hour_of_day", F.hour("event_ts")),
        "hour_of_day",
        unique_visitors=distinct("visitor_id"),
    )
    shown = tally(
        funnel.cells().withColumn("hour_of_day", F.hour("search_ts")),
        "hour_of_day",
        impressions=F.sum("impressions"),
    )
    joined = same_key(searched, shown, "hour_of_day")
    return (
        _zero_filled(joined, "impressions")
        .select("hour_of_day", "impressions", "unique_visitors")
        .orderBy("hour_of_day")
    )


DIMENSIONS = {
    "s_dim_job_openings": dim_job_openings,
    "s_dim_clients": dim_clients,
    "s_dim_freelancers": dim_freelancers,
}
EXACT_ONLY = {
    "s_impression_position_ctr": impression_position_ctr,
    "s_search_to_click_conversion": search_to_click_conversion,
}
WITH_DISTINCT = {
    "s_job_performance_ctr": job_performance_ctr,
    "s_search_query_performance": search_query_performance,
    "s_category_performance": category_performance,
    "s_sublocation_performance": sublocation_performance,
    "s_daily_metrics": daily_metrics,
    "s_visitor_engagement": visitor_engagement,
    "s_job_click_engagement": job_click_engagement,
    "s_hourly_activity": hourly_activity,
}
