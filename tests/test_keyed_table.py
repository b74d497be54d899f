"""Copy on write by buckets: what is rewritten, what a crash leaves, what stays readable."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from tributary.sources.keyed_table import KeyedTable
from tributary.streaming import entities

SCHEMA = "k int, seq int, name string"


@pytest.fixture
def table(lake, spark):
    return KeyedTable(spark, lake.path("silver", "people"), ["k"], "seq", ["name"], buckets=8)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _files(table):
    return {str(p): p.stat().st_mtime_ns for p in Path(table.path).glob("files/**/*.parquet")}


def test_equals_newest_row_per_key(table, spark):
    rand, best = random.Random(3), {}
    for version in range(4):
        changes = [(rand.choice([None, *range(40)]), rand.choice([None, *range(9)]), rand.choice("abc")) for _ in range(30)]
        for k, seq, name in changes:
            rank = (-1 if seq is None else seq, name)
            if k not in best or rank > best[k][0]:
                best[k] = (rank, (k, seq, name))
        df = spark.createDataFrame(changes, SCHEMA)
        want = sorted((row for _, row in best.values()), key=str)
        assert _rows(table.read(df)) == want
        table.merge(df, version)
        assert _rows(table.read()) == want


def test_untouched_buckets_keep_their_files(table, spark):
    table.merge(spark.createDataFrame([(k, 1, "a") for k in range(100)], SCHEMA), 0)
    before = _files(table)
    known = table.merge(spark.createDataFrame([(7, 2, "b"), (7, 0, "z")], SCHEMA), 1)
    assert len(known.files) == 8 and sorted(known.files.values()) == [0] * 7 + [1]
    after = _files(table)
    assert {p: after[p] for p in before} == before and len(after) == len(before) + 1
    assert _rows(table.read()) == sorted([(7, 2, "b"), *[(k, 1, "a") for k in range(100) if k != 7]], key=str)
    # The old version is still there as it was.
    assert _rows(table.read(version=0)) == sorted([(k, 1, "a") for k in range(100)], key=str)


def test_crash_before_the_manifest_changes_nothing(table, spark, monkeypatch):
    table.merge(spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], SCHEMA), 0)
    change = spark.createDataFrame([(1, 2, "b"), (3, 1, "c")], SCHEMA)
    create = spark.createDataFrame

    def crash(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(type(spark), "createDataFrame", crash)
    with pytest.raises(RuntimeError, match="lost"):
        table.merge(change, 1)
    monkeypatch.undo()
    assert (Path(table.path) / "files" / "version=1").exists()
    assert _rows(table.read()) == [(1, 1, "a"), (2, 1, "a")]
    table.merge(create([(2, 5, "d")], SCHEMA), 2)
    table.remove_old()
    assert not (Path(table.path) / "files" / "version=1").exists()
    assert _rows(table.read()) == [(1, 1, "a"), (2, 5, "d")]


def test_only_files_of_the_last_versions_stay(table, spark):
    for version in range(5):
        table.merge(spark.createDataFrame([(k, version, "x") for k in range(version, 20)], SCHEMA), version)
    assert table.remove_old(keep=2) == 3
    assert sorted(table.numbered("manifest")) == [3, 4]
    assert _rows(table.read(version=3)) and len(_rows(table.read())) == 20
    named = {(v, b) for k in (3, 4) for b, v in table.manifest(k).files.items()}
    stored = {(int(p.parent.name[8:]), int(p.name[6:])) for p in Path(table.path).glob("files/version=*/_part=*")}
    assert stored == named
    with pytest.raises(ValueError, match="follow"):
        table.merge(spark.createDataFrame([(1, 1, "a")], SCHEMA), 4)


def test_only_touched_buckets_are_shuffled(table, spark):
    table.merge(spark.createDataFrame([(k, 1, "a") for k in range(100)], SCHEMA), 0)
    plan = table.read()._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert table.read(spark.createDataFrame([], SCHEMA)).count() == 100


def test_state_without_rows_keeps_its_columns(lake, spark):
    state = entities.CurrentState(lake, lake.path("silver", "none"), ["k"], "seq", ["name"], buckets=4)
    state.apply(spark.createDataFrame([], SCHEMA), 0)
    for batch in range(1, 5):
        state.compact(keep=1)
        assert state.current().count() == 0 and state.current().columns == ["k", "seq", "name"]
        state.apply(spark.createDataFrame([], SCHEMA), batch)
    state.apply(spark.createDataFrame([(1, 1, "a")], SCHEMA), 5)
    state.compact(keep=1)
    assert _rows(state.current()) == [(1, 1, "a")]
    assert list(state.table.numbered("delta")) == []
