"""Gold tables by days: which days are built again, and that the result is that of a whole run."""

from __future__ import annotations

import time
from datetime import date, datetime
from pathlib import Path

import pytest

from tributary.plans.silver import SilverTables
from tributary.sources.tables import BATCH
from tributary.streaming import days

SEARCHES = "search_guid string, visitor_id string, search_query string, sublocation string, event_ts timestamp"
IMPRESSIONS = "event_id string, visitor_id string, search_guid string, opening_uid string, position int, collector_ts timestamp"
CLICKS = IMPRESSIONS + ", event_ts timestamp, time_to_click_secs int"


def _at(number, hour=12):
    return datetime(2024, 3, number, hour)


def _search(guid, number):
    return (guid, "v", "q", "search_results", None if number is None else _at(number))


def _shown(event, guid, job="j"):
    return (event, "v", guid, job, 1, _at(1))


def _clicked(event, guid, job="j", seconds=5):
    return (event, "v", guid, job, 1, _at(1), _at(20), seconds)


def _tables(lake):
    read = [lake.read("silver", name) for name in days.EVENTS]
    return SilverTables(*read, None, None, None)


@pytest.fixture
def add(lake, spark):
    """Append one silver batch per table and refresh."""
    count = iter(range(100))

    def batch(searches=(), impressions=(), clicks=()):
        number = next(count)
        for name, rows, schema in zip(days.EVENTS, (searches, impressions, clicks), (SEARCHES, IMPRESSIONS, CLICKS)):
            path = f"{lake.path('silver', name)}/{BATCH}={number}"
            spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(path)
        return days.refresh_days(lake, _tables)

    return batch


def _same_as_whole_run(lake):
    silver = _tables(lake)
    for table, (build, column) in days.DAY_TABLES.items():
        whole = build(silver) if table == days.FACT else build(silver).drop(column)
        stored = days.read_day_table(lake, table, silver).select(whole.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, whole.collect())), table


def _files(lake):
    return {p: p.stat().st_mtime_ns for p in Path(lake.path("gold", days.FACT)).rglob("*.parquet")}


def test_only_changed_days_are_written(lake, add):
    searches = [_search(f"g{n}", n) for n in range(1, 6)]
    assert add(searches, [_shown(f"i{n}", f"g{n}") for n in range(1, 6)], [_clicked("c1", "g1")]) is None
    _same_as_whole_run(lake)
    before = _files(lake)
    # A late click on the second day and a new search on the ninth.
    assert sorted(add([_search("g9", 9)], [_shown("i9", "g9")], [_clicked("c2", "g2")])) == [date(2024, 3, 2), date(2024, 3, 9)]
    _same_as_whole_run(lake)
    after = _files(lake)
    kept = {p for p in before if "event_date=2024-03-02" not in str(p)}
    assert len(kept) == 4 and all(after.get(p) == before[p] for p in kept)
    assert add() == [] and days.refresh_days(lake, _tables) == []
    assert _files(lake) == after


def test_events_wait_for_their_search(lake, add):
    add([_search("g1", 1)], [_shown("i1", "g1"), _shown("i2", "late"), _shown("i3", "never")], [_clicked("c2", "late")])
    _same_as_whole_run(lake)
    assert set(add(impressions=[_shown("i4", "late", "k")])) == {None}
    _same_as_whole_run(lake)
    assert set(add([_search("late", 4), _search("untimed", None)])) == {None, date(2024, 3, 4)}
    _same_as_whole_run(lake)
    assert set(add([_search("never", 4)], clicks=[_clicked("c3", "never")])) == {None, date(2024, 3, 4)}
    _same_as_whole_run(lake)
    # No event is left without a day, so its partition is gone.
    assert not list(Path(lake.path("gold", days.FACT)).glob(f"*={days.NO_DAY}"))


def test_a_run_that_broke_off_is_made_again(lake, add, monkeypatch):
    add([_search("g1", 1)], [_shown("i1", "g1")])
    monkeypatch.setattr(days, "_mark", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        add([_search("g2", 1)], [_shown("i2", "g2")], [_clicked("c1", "g1")])
    monkeypatch.undo()
    assert days.refresh_days(lake, _tables) == [date(2024, 3, 1)]
    _same_as_whole_run(lake)


def test_without_rows(lake, add):
    assert add() is None
    _same_as_whole_run(lake)
    assert add([_search("g1", 1)]) == [date(2024, 3, 1)]
    _same_as_whole_run(lake)


def test_event_tables_are_not_broadcast_by_the_size_of_their_files(lake, spark):
    """Zstd files of a few megabytes hold rows that the driver could not hold at scale."""
    guid = "concat('g', id) AS search_guid"
    events = {"search_events": (SEARCHES, 300_000), "impression_events": (IMPRESSIONS, 1), "click_events": (CLICKS, 1)}
    for name, (schema, count) in events.items():
        rows = spark.range(count).selectExpr("'v' AS visitor_id", guid)
        rows = spark.createDataFrame([], schema).unionByName(rows, allowMissingColumns=True).coalesce(1)
        rows.write.option("compression", "zstd").parquet(f"{lake.path('silver', name)}/{BATCH}=0")
    plans = []

    def tables(known):
        silver = _tables(known)
        joined = silver.impressions.join(silver.searches.select("search_guid", "event_ts"), "search_guid", "left")
        plans.append(joined._jdf.queryExecution().sparkPlan().toString())
        return silver

    before = spark.conf.getAll
    days.refresh_days(lake, tables)
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
    assert spark.conf.getAll == before
    _same_as_whole_run(lake)


def test_shuffles_and_stored_rows_go_when_the_days_are_written(add, spark):
    def left():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {p for folder in folders for p in Path(folder).rglob("shuffle_*.data")}

    before = left()
    add([_search("g1", 1)], [_shown("i1", "g1")], [_clicked("c1", "g1")])
    add(impressions=[_shown("i2", "g1", "k")])
    until = time.time() + 20
    while left() - before and time.time() < until:
        time.sleep(0.2)
    assert not left() - before
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).rglob("day-rows-*"))
