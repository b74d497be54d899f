"""Small silver tables written by hand."""

from __future__ import annotations

from datetime import datetime

from tributary.plans.silver import SilverTables

SEARCHES = "search_guid string, visitor_id string, search_query string, sublocation string, sort string, page int, event_ts timestamp"
EVENTS = (
    "event_id string, visitor_id string, search_guid string, opening_uid string, position int, "
    "event_ts timestamp, collector_ts timestamp, is_bot boolean"
)
JOBS = (
    "opening_uid string, title string, category string, budget_type string, client_uid string, "
    "posted_at timestamp, is_active boolean, numeric_budget_amount double"
)
CLIENTS = (
    "client_uid string, company_name string, country string, industry string, payment_verified boolean, "
    "member_since date, avg_rating double, numeric_total_spend_usd double"
)
FREELANCERS = (
    "visitor_id string, name string, country string, primary_skill string, member_since date, top_rated boolean, "
    "is_verified boolean, numeric_hourly_rate double, numeric_job_success_score double"
)


def at(hour: int, day: int = 15) -> datetime:
    return datetime(2024, 1, day, hour)


def search(guid, visitor="v1", query="spark", place="search_results", hour=9):
    return (guid, visitor, query, place, "recency", 1, at(hour))


def shown(event, guid, job, position=1, visitor="v1"):
    return (event, visitor, guid, job, position, at(9), at(9), False)


def click(event, guid, job, seconds, visitor="v1", hour=9, position=1):
    return (event, visitor, guid, job, position, at(hour), at(hour), False, seconds)


def job(uid, category="Data", client="c1", budget=100.0, active=True):
    return (uid, f"job {uid}", category, "fixed", client, at(0, 1), active, budget)


def client(uid, name="Acme", spend=10.0):
    return (uid, name, "US", "IT", True, at(0).date(), 4.0, spend)


def tables(spark, searches=(), impressions=(), clicks=(), jobs=(), clients=(), freelancers=()) -> SilverTables:
    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return SilverTables(
        frame(searches, SEARCHES),
        frame(impressions, EVENTS),
        frame(clicks, EVENTS + ", time_to_click_secs double"),
        frame(jobs, JOBS),
        frame(clients, CLIENTS),
        frame(freelancers, FREELANCERS),
    )


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def by(df, key) -> dict:
    return {r[key]: r for r in rows(df)}
