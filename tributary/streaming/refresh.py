"""One run from new landing files to fresh marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from tributary.operators.expectations import Rule, enforce
from tributary.plans import marts_exact, marts_funnel, reports, star
from tributary.plans.silver import DAILY_MART_RULES, JOB_MART_RULES, SilverTables
from tributary.schemas import BRONZE_COMMENTS, GOLD_COMMENTS, RAW
from tributary.session import BUILDING, settings
from tributary.sources.tables import Lake
from tributary.streaming import bronze, days, entities, events

MART_RULES: dict[str, list[Rule]] = {
    "p_job_performance": JOB_MART_RULES,
    "p_daily_metrics": DAILY_MART_RULES,
}


def refresh_silver(lake: Lake, root: str | None = None) -> SilverTables:
    """Take in new files, validate new events and update the entities."""
    with settings(lake.spark, BUILDING):
        return _refreshed_silver(lake, root)


def _refreshed_silver(lake: Lake, root: str | None) -> SilverTables:
    bronze.ingest(lake, list(RAW), root)
    running = [events.start(lake, name) for name in events.EVENT_FLOWS]
    running.append(events.start_quarantine(lake))
    running += [entities.start(lake, name) for name in entities.ENTITY_FLOWS]
    for query in running:
        query.awaitTermination()
    for name in entities.ENTITY_FLOWS:
        entities.state(lake, name).compact()
    return silver_tables(lake)


def silver_tables(lake: Lake) -> SilverTables:
    """The stored silver layer."""
    return SilverTables(
        events.read_events(lake, "search_events"),
        events.read_events(lake, "impression_events"),
        events.read_events(lake, "click_events"),
        entities.state(lake, "job_openings").current(),
        entities.state(lake, "clients").current(),
        entities.state(lake, "freelancers").current(),
    )


def _store(lake: Lake, table: str, df: DataFrame, run: int) -> DataFrame:
    rules = MART_RULES.get(table)
    if not rules:
        return lake.materialize(df, "gold", table)
    seen = Observation()
    stored = lake.materialize(enforce(df, rules, seen), "gold", table)
    events.write_log(lake, f"gold.{table}", run, rules, seen.get)
    return stored


def refresh_gold(lake: Lake, silver: SilverTables, run: int = 0) -> dict[str, DataFrame]:
    """Bring fact and cells up to date, by days; recompute dimensions, marts and reports. Each reads stored tables."""
    with settings(lake.spark, BUILDING):
        return _refreshed_gold(lake, silver, run)


def _refreshed_gold(lake: Lake, silver: SilverTables, run: int) -> dict[str, DataFrame]:
    days.refresh_days(lake, silver_tables)
    gold = {table: days.read_day_table(lake, table, silver) for table in days.DAY_TABLES}
    per_silver = {
        **star.TABLES,
        **marts_exact.MARTS,
        **marts_funnel.DIMENSIONS,
        "s_fact_search_funnel": marts_funnel.funnel_fact,
    }
    for table, build in per_silver.items():
        if table in days.DAY_TABLES:
            continue
        gold[table] = _store(lake, table, build(silver), run)
    funnel = marts_funnel.Funnel(silver, gold["funnel_cells"])
    for table, build in marts_funnel.EXACT_ONLY.items():
        gold[table] = _store(lake, table, build(funnel), run)
    for table, build in marts_funnel.WITH_DISTINCT.items():
        gold[table] = _store(lake, table, build(funnel, marts_funnel.approximate), run)
    postings = reports.client_posting_performance(gold["p_job_performance"], silver.clients)
    gold["client_posting_performance"] = _store(lake, "client_posting_performance", postings, run)
    benchmark = reports.client_category_benchmark(
        gold["p_job_performance"], gold["p_category_performance"], silver.clients
    )
    gold["client_category_benchmark"] = _store(lake, "client_category_benchmark", benchmark, run)
    chances = reports.client_opportunities(
        gold["client_posting_performance"], gold["client_category_benchmark"]
    )
    gold["client_opportunities"] = _store(lake, "client_opportunities", chances, run)
    return gold


def refresh(lake: Lake, root: str | None = None, run: int = 0) -> dict[str, DataFrame]:
    """The whole run; returns the gold tables by name."""
    return refresh_gold(lake, refresh_silver(lake, root), run)


def publish(lake: Lake, prefix: str = "") -> list[str]:
    """Name the bronze and gold tables in the catalog with their comments."""
    layers = (("bronze", BRONZE_COMMENTS), ("gold", GOLD_COMMENTS))
    return [lake.publish(layer, name, text, prefix) for layer, texts in layers for name, text in texts.items()]
