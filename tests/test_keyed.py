"""Newest row per key."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.operators import keyed
from tributary.operators.keyed import first_per_key, latest_per_key
from tributary.operators.rollup import same_key

SCHEMA = "k int, seq int, name string"
changes = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("abc")), min_size=1, max_size=12
)


def _expected(rows):
    best = {}
    for row in rows:
        rank = (-1 if row[1] is None else row[1], row[2])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    return sorted((r for _, r in best.values()), key=str)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=changes, seed=st.randoms())
def test_result_does_not_depend_on_arrival(spark, rows, seed):
    shuffled = list(rows)
    seed.shuffle(shuffled)
    for version in (rows, shuffled):
        df = spark.createDataFrame(version, SCHEMA)
        got = sorted((tuple(r) for r in latest_per_key(df, ["k"], "seq").collect()), key=str)
        assert got == _expected(rows)


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"), F.lit("x").alias("name"))
    newest = latest_per_key(df, ["k"], "seq")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert {r.k: r.seq for r in newest.collect()} == {0: 999, 1: 997, 2: 998}


def test_first_per_key_keeps_all_columns(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "c"), (2, None, "a")], SCHEMA)
    got = first_per_key(df, ["k"], [F.col("seq").asc_nulls_last()])
    assert got.columns == ["k", "seq", "name"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, "c"), (2, None, "a")]


def test_inner_names_may_be_taken(spark):
    """Columns named like the ones the operators add for themselves."""
    left = spark.createDataFrame([(1, "a", 5, 6), (2, None, 7, 8)], "k int, _spread string, _rank int, _other_key int")
    right = spark.createDataFrame([(1, 10), (2, 20)], "k int, __spread int")
    joined = keyed.join_grouped(left, right, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in joined] == [(1, "a", 5, 6, 10), (2, None, 7, 8, 20)]
    assert keyed.latest_per_key(left.unionAll(left), ["k"], "_rank").orderBy("k").collect() == left.orderBy("k").collect()
    both = same_key(left, right, "k")
    assert sorted(both.columns) == ["__spread", "_other_key", "_rank", "_spread", "k"] and both.count() == 2
