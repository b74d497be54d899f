"""Silver: typed, validated events and cleaned entity records."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import lenient_double, lenient_int, numeric_text, text_flag
from tributary.operators.expectations import Rule, drop, enforce, quarantine, warn

# Rule names and predicates.
SEARCH_RULES = [
    drop("valid_visitor_id", "visitor_id IS NOT NULL"),
    drop("valid_search_guid", "search_guid IS NOT NULL"),
    drop("valid_sublocation", "sublocation IN ('search_results', 'featured_jobs')"),
]
IMPRESSION_RULES = [
    drop("valid_visitor_id", "visitor_id IS NOT NULL"),
    drop("valid_search_guid", "search_guid IS NOT NULL"),
    drop("valid_opening_uid", "opening_uid IS NOT NULL"),
    drop("valid_position", "position IS NOT NULL"),
    drop("valid_visitors", "is_bot = false"),
]
CLICK_RULES = [
    drop("valid_visitor_id", "visitor_id IS NOT NULL"),
    drop("valid_search_guid", "search_guid IS NOT NULL"),
    drop("valid_opening_uid", "opening_uid IS NOT NULL"),
    drop("valid_position", "position IS NOT NULL"),
    drop("valid_time_to_click_secs", "time_to_click_secs IS NOT NULL"),
    drop("valid_visitors", "is_bot = false"),
]
JOB_MART_RULES = [warn("clicks_le_impressions", "clicks <= impressions OR clicks IS NULL")]
DAILY_MART_RULES = [warn("positive_ctr", "ctr_pct IS NULL OR (ctr_pct >= 0 AND ctr_pct <= 100)")]

# Reasons shown for quarantined clicks, the documented ones first; a row that violates several
# rules is shown with the first of them.
CLICK_REASONS = [
    drop("bot_traffic", "is_bot = false"),
    drop("null_event_id", "event_id IS NOT NULL"),
    drop("invalid_position", "position IS NOT NULL"),
    *CLICK_RULES,
]


def typed_impressions(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"position": lenient_int("position"), "is_bot": text_flag("is_bot")})


def typed_clicks(raw: DataFrame) -> DataFrame:
    """Types first, rules afterwards: a word in the time column becomes NULL and then fails its rule."""
    return typed_impressions(raw).withColumn("time_to_click_secs", lenient_double("time_to_click_secs"))


def search_events(raw: DataFrame, observation=None) -> DataFrame:
    return enforce(raw, SEARCH_RULES, observation)


def impression_events(raw: DataFrame, observation=None) -> DataFrame:
    return enforce(typed_impressions(raw), IMPRESSION_RULES, observation)


def click_events(raw: DataFrame, observation=None) -> DataFrame:
    return enforce(typed_clicks(raw), CLICK_RULES, observation)


def quarantine_impressions(raw: DataFrame) -> DataFrame:
    """Bot impressions, kept for fraud monitoring."""
    return typed_impressions(raw).filter("is_bot")


def rejected_impressions(raw: DataFrame) -> DataFrame:
    """Every impression that silver rejects, and the reason; bots are among them."""
    return quarantine(typed_impressions(raw), IMPRESSION_RULES)


def quarantine_clicks(raw: DataFrame) -> DataFrame:
    """Every click that silver rejects, and the reason; no row is in neither table or in both."""
    return quarantine(typed_clicks(raw), CLICK_RULES, CLICK_REASONS)


def quarantine_balance(raw) -> DataFrame:
    """Rows of the two event tables with a quarantine: taken in, accepted, quarantined."""
    flows = [
        ("click_events", raw.click_events, click_events, quarantine_clicks),
        ("impression_events", raw.impression_events, impression_events, rejected_impressions),
    ]
    out = None
    for name, rows, accept, reject in flows:
        parts = [
            part.select(F.lit(name).alias("dataset"), F.lit(i).alias("part"))
            for i, part in enumerate((rows, accept(rows), reject(rows)))
        ]
        both = parts[0].unionAll(parts[1]).unionAll(parts[2])
        out = both if out is None else out.unionAll(both)
    count = [F.count(F.when(F.col("part") == i, 1)).alias(n) for i, n in enumerate(("bronze", "silver", "quarantined"))]
    return out.groupBy("dataset").agg(*count)


def clean_freelancers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "numeric_hourly_rate": lenient_double("hourly_rate"),
            "numeric_job_success_score": lenient_double("job_success_score"),
        }
    )


def clean_clients(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "processed_at": F.current_timestamp(),
            "numeric_total_spend_usd": lenient_double("total_spend_usd"),
        }
    )


def clean_jobs(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "processed_at": F.current_timestamp(),
            "numeric_budget_amount": lenient_double("budget_amount"),
        }
    ).drop("budget_amount")


# Documented rules that the coded ones above replace or leave out. `as_of` is
# the moment against which a date is in the future.
def documented_rules(as_of: str) -> dict[str, list[Rule]]:
    moment, date = f"TIMESTAMP_NTZ '{as_of}'", f"DATE '{as_of[:10]}'"
    return {
        "search_events": [
            drop("valid_search_guid", "search_guid IS NOT NULL"),
            drop("valid_visitor_id", "visitor_id IS NOT NULL"),
            warn("known_sublocation", "sublocation IN ('search_results', 'featured_jobs')"),
            warn("known_sort", "sort IN ('recency', 'relevance')"),
            warn("not_future_event", f"event_ts <= {moment}"),
        ],
        "impression_events": [
            drop("valid_event_id", "event_id IS NOT NULL"),
            drop("no_bots", "is_bot = false"),
        ],
        "click_events": [
            drop("valid_event_id", "event_id IS NOT NULL"),
            drop("no_bots", "is_bot = false"),
            warn("not_negative_time", "time_to_click_secs >= 0 OR time_to_click_secs IS NULL"),
            warn("not_future_event", f"event_ts <= {moment}"),
        ],
        "job_openings": [
            drop("valid_title", "title IS NOT NULL"),
            warn("not_negative_budget", "numeric_budget_amount >= 0 OR numeric_budget_amount IS NULL"),
            warn("not_future_post", f"posted_at <= {moment}"),
        ],
        "clients": [warn("not_future_member", f"member_since <= {date}")],
        "freelancers": [
            warn("not_negative_score", "numeric_job_success_score >= 0 OR numeric_job_success_score IS NULL"),
        ],
    }


def documented_clicks(raw: DataFrame) -> DataFrame:
    """Clicks typed the documented way: numbers by pattern, organic clicks kept."""
    return typed_impressions(raw).withColumn("time_to_click_secs", numeric_text("time_to_click_secs"))


def documented_entities(raw: DataFrame, numbers: dict[str, str]) -> DataFrame:
    """Entity records with `numbers` (new column: text column) parsed by pattern."""
    return raw.withColumns({new: numeric_text(text) for new, text in numbers.items()})


@dataclass
class SilverTables:
    """The six silver tables the marts read."""

    searches: DataFrame
    impressions: DataFrame
    clicks: DataFrame
    jobs: DataFrame
    clients: DataFrame
    freelancers: DataFrame


class SilverOverRaw:
    """The same six tables computed from raw ones, each only when it is read.

    For raw entity records that already hold one row per key.
    """

    def __init__(self, raw):
        self._raw = raw

    @cached_property
    def searches(self) -> DataFrame:
        return search_events(self._raw.search_events)

    @cached_property
    def impressions(self) -> DataFrame:
        return impression_events(self._raw.impression_events)

    @cached_property
    def clicks(self) -> DataFrame:
        return click_events(self._raw.click_events)

    @cached_property
    def jobs(self) -> DataFrame:
        return clean_jobs(self._raw.job_openings)

    @cached_property
    def clients(self) -> DataFrame:
        return clean_clients(self._raw.clients)

    @cached_property
    def freelancers(self) -> DataFrame:
        return clean_freelancers(self._raw.freelancers)
