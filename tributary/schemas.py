"""Declared schemas of the six raw datasets and the layer names."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LAYERS = ("raw", "bronze", "silver", "gold")

RESCUED = "_rescued_data"
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"

_TYPES = {
    "string": StringType,
    "int": IntegerType,
    "double": DoubleType,
    "boolean": BooleanType,
    "date": DateType,
    "timestamp": TimestampType,
}


def columns(text: str) -> StructType:
    """Schema from `name type, name type`; needs no running session."""
    pairs = [item.split() for item in text.split(",")]
    return StructType([StructField(name, _TYPES[kind]()) for name, kind in pairs])


# Column names and types of the raw files. Mixed-type columns
# (a number or a word) are declared as strings and parsed in silver.
RAW = {
    "search_events": columns(
        "search_guid string, visitor_id string, search_query string, sublocation string, "
        "sort string, page int, event_ts timestamp"
    ),
    "impression_events": columns(
        "event_id string, visitor_id string, search_guid string, opening_uid string, "
        "position string, event_ts timestamp, collector_ts timestamp, is_bot string"
    ),
    "click_events": columns(
        "event_id string, visitor_id string, search_guid string, opening_uid string, "
        "position string, event_ts timestamp, collector_ts timestamp, is_bot string, "
        "time_to_click_secs string"
    ),
    "job_openings": columns(
        "opening_uid string, title string, category string, budget_type string, "
        "budget_amount string, client_uid string, posted_at timestamp, is_active boolean"
    ),
    "clients": columns(
        "client_uid string, company_name string, country string, industry string, "
        "payment_verified boolean, total_spend_usd string, member_since date, avg_rating double"
    ),
    "freelancers": columns(
        "visitor_id string, name string, country string, primary_skill string, "
        "hourly_rate string, job_success_score string, member_since date, "
        "top_rated boolean, is_verified boolean"
    ),
}

# Comment shown for each table.
BRONZE_COMMENTS = {
    "search_events": "Searches as they arrived, one row per search",
    "impression_events": "Impressions as they arrived, one row per job shown",
    "click_events": "Clicks as they arrived, one row per click",
    "job_openings": "Job postings as they arrived",
    "clients": "Client profiles as they arrived",
    "freelancers": "Freelancer profiles as they arrived",
}

GOLD_COMMENTS = {
    "p_job_performance": "Funnel per job, NULL where nothing was clicked",
    "p_search_query_performance": "Funnel per search term",
    "p_position_ctr": "Click-through rate per position",
    "p_category_performance": "Funnel and budget per job category",
    "p_sublocation_performance": "Featured placement against organic results",
    "p_daily_metrics": "Funnel per day",
    "dim_job": "One row per job",
    "dim_client": "One row per client with its posting activity",
    "dim_category": "One row per job category",
    "dim_freelancer": "One row per freelancer",
    "dim_date": "One row per day with a search",
    "dim_search": "One row per search",
    "fact_search_events": "One row per impression with its search and click outcome",
    "s_fact_search_funnel": "Searches with their impressions and clicks",
    "client_posting_performance": "One row per posting with segment and action",
    "client_category_benchmark": "Each client beside the marketplace, per category",
    "client_opportunities": "Active postings with the lever that promises most",
}
