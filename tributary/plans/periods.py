"""Distinct visitors, sessions and jobs per day, week and month from one stored set of daily states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import day
from tributary.operators import distinct
from tributary.operators.rollup import tally
from tributary.plans.silver import SilverTables
from tributary.session import kept

KINDS = {"visitor": "unique_visitors", "search": "search_sessions", "job": "unique_jobs_shown"}
GRAINS = ("day", "week", "month")


def shown_ids(silver: SilverTables) -> DataFrame:
    """event_date, kind, id: who and what was shown on each day, dated by the search; one scan of impressions.

    Impressions are reduced to distinct triples before they meet the searches, and ids to one row per day after it.
    """
    triples = tally(silver.impressions, ["search_guid", "visitor_id", "opening_uid"])
    days = silver.searches.select("search_guid", day("event_ts").alias("event_date"))
    columns = {"visitor": "visitor_id", "search": "search_guid", "job": "opening_uid"}
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("id")) for k, c in columns.items()])
    return triples.join(days, "search_guid", "left").select("event_date", F.inline(pairs)).distinct()


def daily_states(silver: SilverTables, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored bitmaps per day and kind, and the stored codes of all ids; pass earlier codes as `known` for later days."""
    ids = kept(shown_ids(silver), "shown-ids")
    codes = kept(distinct.numbered(ids, known), "id-codes")
    return kept(distinct.states(ids, ["event_date"], codes), "daily-ids"), codes


def by_period(daily: DataFrame) -> DataFrame:
    """grain, period_start and the exact distinct counts, from the states alone."""
    out = None
    for grain in GRAINS:
        start = F.to_date(F.date_trunc(grain, "event_date")).alias("period_start")
        rows = distinct.counted(distinct.merged(daily, [start]), ["period_start"], KINDS)
        rows = rows.select(F.lit(grain).alias("grain"), "period_start", *KINDS.values())
        out = rows if out is None else out.unionAll(rows)
    return out
