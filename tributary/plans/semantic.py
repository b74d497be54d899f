"""The metric views of the marketplace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.metric_view import MetricView, load_spec
from tributary.operators.rollup import tally
from tributary.plans.marts_funnel import Funnel, dim_clients, dim_freelancers, dim_job_openings
from tributary.plans.silver import SilverTables


def _columns(prefix: str, names: str) -> list[dict]:
    return [
        {"name": n, "expr": f"{prefix}.{n}", "display_name": n.replace("_", " ").title()} for n in names.split()
    ]


def _rounded(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _ctr_pct(clicks: str, impressions: str) -> str:
    return _rounded(f"try_divide({clicks}, {impressions}) * 100")


# Names of dimensions and measures, their formulas and synonyms.
CLICKSTREAM = {
    "source": "fact_search_funnel",
    "joins": [
        {
            "name": "freelancers",
            "source": "dim_freelancers",
            "on": "source.visitor_id = freelancers.visitor_id",
        },
        {
            "name": "job_openings",
            "source": "dim_job_openings",
            "on": "source.opening_uid = job_openings.opening_uid",
            "joins": [
                {
                    "name": "clients",
                    "source": "dim_clients",
                    "on": "job_openings.client_uid = clients.client_uid",
                }
            ],
        },
    ],
    "dimensions": [
        *_columns(
            "source",
            "search_guid opening_uid visitor_id search_query sublocation search_ts impression_id position "
            "click_id time_to_click_secs",
        ),
        *_columns(
            "freelancers",
            "name country primary_skill member_since top_rated is_verified numeric_hourly_rate "
            "numeric_job_success_score",
        ),
        *_columns(
            "job_openings",
            "title category budget_type client_uid posted_at is_active numeric_budget_amount",
        ),
        *_columns(
            "job_openings.clients",
            "company_name industry payment_verified avg_rating numeric_total_spend_usd",
        ),
    ],
    "measures": [
        {
            "name": "total_impressions",
            "expr": "COUNT(source.impression_id)",
            "parts": {"shown": "COUNT(source.impression_id)"},
            "combine": "COALESCE(SUM(source.shown), 0)",
            "display_name": "Total Impressions",
            "decimal_places": 0,
            "synonyms": ["Total Impressions", "Impressions"],
        },
        {
            "name": "CTR",
            "expr": "try_divide(COUNT(source.click_id), COUNT(source.impression_id))",
            "parts": {"shown": "COUNT(source.impression_id)", "clicked": "COUNT(source.click_id)"},
            "combine": "try_divide(SUM(source.clicked), SUM(source.shown))",
            "display_name": "CTR",
            "decimal_places": 2,
            "synonyms": ["Click-Through Rate", "Click Rate", "Engagement Rate", "Search Effectiveness"],
        },
    ],
}

CLIENT_PORTFOLIO = {
    "source": "client_posting_performance",
    "dimensions": _columns("source", "company_name client_uid"),
    "measures": [
        {"name": "clients_tracked", "expr": "COUNT(DISTINCT source.client_uid)"},
        {"name": "jobs_posted", "expr": "COUNT(source.opening_uid)"},
        {"name": "active_jobs", "expr": "COUNT_IF(source.is_active)"},
        {"name": "total_impressions", "expr": "SUM(source.impressions)"},
        {"name": "total_clicks", "expr": "SUM(source.clicks)"},
        {"name": "ctr_pct", "expr": _ctr_pct("SUM(source.clicks)", "SUM(source.impressions)")},
        {"name": "avg_budget_amount", "expr": _rounded("AVG(source.budget_amount)")},
        {"name": "unique_categories", "expr": "COUNT(DISTINCT source.category)"},
    ],
}

CATEGORY_PERFORMANCE = {
    "source": "client_posting_performance",
    "dimensions": _columns("source", "category"),
    "measures": [
        {"name": "impressions", "expr": "SUM(source.impressions)"},
        {"name": "clicks", "expr": "SUM(source.clicks)"},
        {"name": "ctr_pct", "expr": _ctr_pct("SUM(source.clicks)", "SUM(source.impressions)")},
        {"name": "ctr", "expr": "try_divide(SUM(source.clicks), SUM(source.impressions))"},
        {"name": "avg_budget_amount", "expr": _rounded("AVG(source.budget_amount)")},
    ],
}

# The funnel added up: a row stands for many funnel rows.
_FUNNEL_COUNTS = [
    {"name": "impressions", "expr": "SUM(source.impressions)"},
    {"name": "clicks", "expr": "SUM(source.clicks)"},
    {"name": "ctr_pct", "expr": _ctr_pct("SUM(source.clicks)", "SUM(source.impressions)")},
    {"name": "avg_time_to_click_secs", "expr": _rounded("try_divide(SUM(source.time_total), SUM(source.times))", 1)},
]

SEARCH_FUNNEL = {
    "source": "funnel_per_search",
    "dimensions": [
        *_columns("source", "search_query sublocation"),
        {"name": "search_date", "expr": "TO_DATE(source.search_ts)"},
    ],
    "measures": [
        {"name": "searches", "expr": "COUNT(DISTINCT source.search_guid)"},
        {
            "name": "searches_with_clicks",
            "expr": "COUNT(DISTINCT CASE WHEN source.clicks > 0 THEN source.search_guid END)",
        },
        *_FUNNEL_COUNTS,
    ],
}

POSITION_BIAS = {
    "source": "funnel_cells",
    "dimensions": _columns("source", "position sublocation"),
    "measures": _FUNNEL_COUNTS,
}


# A view as a spec file holds it.
PLACEMENT_SPEC = """
source: fact_search_funnel
dimensions:
  - name: placement
    expr: source.sublocation
  - name: search_page_position
    expr: source.position
measures:
  - name: shown
    expr: COUNT(source.impression_id)
  - name: clicked
    expr: COUNT(source.click_id)
  - name: click_share
    expr: ROUND(TRY_DIVIDE(COUNT(source.click_id), COUNT(source.impression_id)), 4)
    display_name: Share of impressions that were clicked
"""


def placement_view(fact: DataFrame) -> MetricView:
    return MetricView(load_spec(PLACEMENT_SPEC), {"fact_search_funnel": fact})


def clickstream_view(fact: DataFrame, silver: SilverTables) -> MetricView:
    return MetricView(
        CLICKSTREAM,
        {
            "fact_search_funnel": fact,
            "dim_freelancers": dim_freelancers(silver),
            "dim_job_openings": dim_job_openings(silver),
            "dim_clients": dim_clients(silver),
        },
    )


def client_portfolio_view(postings: DataFrame) -> MetricView:
    return MetricView(CLIENT_PORTFOLIO, {"client_posting_performance": postings})


def category_view(postings: DataFrame) -> MetricView:
    return MetricView(CATEGORY_PERFORMANCE, {"client_posting_performance": postings})


def search_funnel_view(funnel: Funnel) -> MetricView:
    """Over one row per search, so distinct searches are counted over few rows."""
    search = ["search_guid", "search_query", "sublocation", "search_ts"]
    sums = {n: F.sum(n) for n in ("impressions", "clicks", "times", "time_total")}
    return MetricView(SEARCH_FUNNEL, {"funnel_per_search": tally(funnel.with_unshown(funnel.cells()), search, **sums)})


def position_bias_view(funnel: Funnel) -> MetricView:
    return MetricView(POSITION_BIAS, {"funnel_cells": funnel.with_unshown(funnel.cells(by_position=True))})
