"""Gold tables with a partition per day of the search, refreshed only where something changed.

New silver rows tell which days they touch: a search its own, an impression or a click that of its search, however
late it comes. Only these days are built again, from silver, and replace their partitions. The batches that are in
the gold tables are written down last, so a run that broke off is simply made again.

Days come to the driver as a list, which the calendar bounds. Impressions whose search is unknown, or has no time,
lie in the partition without a day; that one is built again when such a row arrives or finds its search.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import day
from tributary.plans import marts_funnel, star
from tributary.plans.silver import SilverTables
from tributary.session import COMPRESSED, joining_events, scratch_dir, settings
from tributary.sources.tables import BATCH, Lake

EVENTS = ("search_events", "impression_events", "click_events")
FACT = "fact_search_events"
# The folder in which Spark keeps the rows of a partitioned table without a partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_DONE = "table string, batch bigint"


def _cells(silver: SilverTables) -> DataFrame:
    cells = marts_funnel.Funnel(silver).cells(by_time=True, by_position=True)
    return cells.withColumn("search_date", day("search_ts"))


# Table: how it is built, and the column that holds the day of the search.
DAY_TABLES: dict[str, tuple[Callable[[SilverTables], DataFrame], str]] = {
    FACT: (star.fact_search_events, "event_date"),
    "funnel_cells": (_cells, "search_date"),
}


def read_day_table(lake: Lake, table: str, silver: SilverTables) -> DataFrame:
    """A stored table as its builder gives it: the day stays only where it is a column of the table itself.

    The builder's schema is used, so a table without rows or without any day has its columns too.
    """
    build, column = DAY_TABLES[table]
    stored = lake.spark.read.schema(build(silver).schema).parquet(lake.path("gold", table))
    return stored if table == FACT else stored.drop(column)


def _marks(lake: Lake) -> str:
    return lake.checkpoint("gold_days")


def done(lake: Lake) -> dict[str, int] | None:
    """The last batch of every event table that the gold tables hold; None before the first run."""
    runs = lake.numbers(_marks(lake))
    if not runs:
        return None
    rows = lake.spark.read.schema(_DONE).parquet(f"{_marks(lake)}/run={runs[-1]}").collect()
    return {r["table"]: r["batch"] for r in rows}


def _mark(lake: Lake, batches: dict[str, int]) -> None:
    run = max(lake.numbers(_marks(lake)), default=-1) + 1
    rows = lake.spark.createDataFrame(list(batches.items()), _DONE)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{_marks(lake)}/run={run}")


def _arrived(lake: Lake, name: str, after: int, through: int) -> DataFrame:
    """Rows of the batches after one and through another; only their partitions are read."""
    rows = lake.spark.read.parquet(lake.path("silver", name))
    return rows.filter((F.col(BATCH) > after) & (F.col(BATCH) <= through)).drop(BATCH)


def changed_days(lake: Lake, silver: SilverTables, before: dict[str, int], now: dict[str, int]) -> list[date | None]:
    """Days with new searches, or whose searches have new impressions or clicks; None stands for no day."""
    fresh = {name: _arrived(lake, name, before.get(name, -1), now.get(name, -1)) for name in EVENTS if name in now}
    found = []
    searched = silver.searches.select("search_guid", day("event_ts").alias("day"))
    touched = [fresh[name].select("search_guid") for name in EVENTS[1:] if name in fresh]
    for rows in touched:
        guids = rows.distinct()
        # A left join keeps events of unknown searches: their day is null.
        found.append(guids.join(searched, "search_guid", "left").select("day"))
    if "search_events" in fresh:
        own = fresh["search_events"].select("search_guid", day("event_ts").alias("day"))
        found.append(own.select("day"))
        # Impressions that waited for one of these searches leave the partition without a day.
        waiting = read_day_table(lake, FACT, silver).filter("event_date IS NULL").select("search_guid").distinct()
        found.append(own.join(waiting, "search_guid", "left_semi").select(F.lit(None).cast("date").alias("day")))
    if not found:
        return []
    days = found[0]
    for more in found[1:]:
        days = days.unionAll(more)
    return [r["day"] for r in days.distinct().collect()]


def of_days(silver: SilverTables, days: list[date | None]) -> SilverTables:
    """The silver rows of the searches of some days; with None also events whose search is unknown."""
    on, listed = day("event_ts"), [d for d in days if d is not None]
    wanted = on.isin(listed)
    if listed:
        # A plain range of the time, which the scan can use.
        kind = silver.searches.schema["event_ts"].dataType
        first, end = (F.lit(d.isoformat()).cast(kind) for d in (min(listed), max(listed) + timedelta(days=1)))
        wanted = wanted & (F.col("event_ts") >= first) & (F.col("event_ts") < end)
    if None in days:
        wanted = wanted | on.isNull()
    searches = silver.searches.filter(wanted)
    own, known = searches.select("search_guid"), silver.searches.select("search_guid")

    def events(rows: DataFrame) -> DataFrame:
        kept = rows.join(own, "search_guid", "left_semi")
        if None in days:
            kept = kept.unionByName(rows.join(known, "search_guid", "left_anti"))
        return kept

    return SilverTables(
        searches, events(silver.impressions), events(silver.clicks), silver.jobs, silver.clients, silver.freelancers
    )


def _replace_days(lake: Lake, table: str, rows: DataFrame, options: dict[str, str]) -> None:
    """Write rows to the partitions of their days.

    The rows are stored before they are dealt out by day: as files they take a third of what they take in a
    shuffle, and what the joins shuffled is gone when the days are.
    """
    column = DAY_TABLES[table][1]
    path = scratch_dir(lake.spark, "day-rows")
    rows.write.options(**COMPRESSED).parquet(path)
    stored = lake.spark.read.schema(rows.schema).parquet(path).hint("rebalance", column)
    stored.write.mode("overwrite").options(**COMPRESSED, **options).partitionBy(column).parquet(lake.path("gold", table))
    lake.remove(path)


def refresh_days(lake: Lake, tables: Callable[[Lake], SilverTables]) -> list[date | None] | None:
    """Bring the tables of `DAY_TABLES` up to date; returns the days built again, None for all in a first run.

    A run without changes writes nothing.
    """
    with settings(lake.spark, joining_events(lake.spark)):
        return _refreshed_days(lake, tables)


def _refreshed_days(lake: Lake, tables: Callable[[Lake], SilverTables]) -> list[date | None] | None:
    before, now = done(lake), {}
    for name in EVENTS:
        batches = lake.numbers(lake.path("silver", name))
        if batches:
            now[name] = batches[-1]
    if before == now:
        return []
    silver = tables(lake)
    if before is None:
        for table, (build, _) in DAY_TABLES.items():
            _replace_days(lake, table, build(silver), {})
        _mark(lake, now)
        return None
    days = changed_days(lake, silver, before, now)
    if days:
        part = of_days(silver, days)
        for table, (build, column) in DAY_TABLES.items():
            if None in days:
                lake.remove(f"{lake.path('gold', table)}/{column}={NO_DAY}")
            _replace_days(lake, table, build(part), {"partitionOverwriteMode": "dynamic"})
    _mark(lake, now)
    return days
