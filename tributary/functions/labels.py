"""Business labels. Thresholds and label texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MANY_IMPRESSIONS = 20
FEW_IMPRESSIONS = 10
LOW_CTR = 2
GOOD_CTR = 5

# (segment, action) in the order in which the rules are tried.
POSTING_LABELS = (
    ("High visibility, low engagement", "Refresh title or posting copy"),
    ("Low visibility, strong engagement", "Increase visibility or distribution"),
    ("Active posting needs attention", "Review budget and targeting"),
)
POSTING_DEFAULT = ("Steady performance", "Maintain current strategy")

OPPORTUNITY_LABELS = ("Improve conversion", "Increase visibility", "Review budget competitiveness")
OPPORTUNITY_DEFAULT = "Monitor"

# Upper bound (exclusive) of each latency bucket in seconds.
LATENCY_BUCKETS = ((3, "< 3s (instant)"), (10, "3-10s"), (30, "10-30s"), (60, "30-60s"))
LATENCY_REST = "> 60s"
LATENCY_UNKNOWN = "unknown"


def first_match(rules: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds."""
    (condition, label), *rest = rules
    out = F.when(condition, F.lit(label))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def posting_labels(impressions: Column, clicks: Column, ctr: Column, active: Column) -> tuple[Column, Column]:
    """(opportunity_segment, recommended_action) of one posting."""
    conditions = [
        (impressions >= MANY_IMPRESSIONS) & (ctr < LOW_CTR),
        (impressions < FEW_IMPRESSIONS) & (ctr >= GOOD_CTR),
        active & (clicks == 0),
    ]
    return tuple(
        first_match(
            [(c, labels[part]) for c, labels in zip(conditions, POSTING_LABELS)], POSTING_DEFAULT[part]
        )
        for part in (0, 1)
    )


def opportunity_type(
    impressions: Column, ctr: Column, budget: Column, market_ctr: Column, market_budget: Column
) -> Column:
    """Compare a posting with its market; a missing market value counts as equal."""
    peer_ctr = F.coalesce(market_ctr, ctr)
    peer_budget = F.coalesce(market_budget, budget)
    conditions = [
        (impressions >= MANY_IMPRESSIONS) & (ctr < peer_ctr),
        (impressions < FEW_IMPRESSIONS) & (ctr >= peer_ctr),
        budget < peer_budget,
    ]
    return first_match(list(zip(conditions, OPPORTUNITY_LABELS)), OPPORTUNITY_DEFAULT)


def latency_bucket(seconds: Column) -> Column:
    """Bucket of the time between impression and click."""
    rules = [(seconds.isNull(), LATENCY_UNKNOWN)]
    rules += [(seconds < limit, label) for limit, label in LATENCY_BUCKETS]
    return first_match(rules, LATENCY_REST)
