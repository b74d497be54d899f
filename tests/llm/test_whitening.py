"""Whitening against a dense eigenvalue decomposition."""

from __future__ import annotations

import numpy as np
import pytest

from tributary.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, whitened double, value string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0.5, "x") for i, v in vectors], SCHEMA)


def dense(vectors, count):
    """Kept rows as whole numbers, centred rows, variances and components."""
    x = np.array([[int(np.floor(float(np.float32(c)) * 64)) + 1_000_000 for c in v] for _, v in vectors], np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:count]
    return ((x * n - sums) ** 2).sum(axis=1), centred, values[order], axes[:, order], values.sum()


@pytest.mark.parametrize("count", [3, 12])
def test_against_dense_eigenvectors(spark, count):
    random = np.random.default_rng(4)
    scale = 2.0 ** -np.arange(12)
    vectors = [(i, (random.standard_normal(12) * scale * 30 + 5).tolist()) for i in range(300)]
    found = whitening.by_component(whitening.whitened(spark, frame(spark, vectors), count)).toPandas()
    deviation, centred, values, axes, trace = dense(vectors, count)
    got = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = centred @ axes / np.sqrt(values)
    sign = np.sign((got * want).sum(axis=0))
    assert np.allclose(got * sign, want, atol=1e-6)
    assert np.allclose(found.groupby("component").explained.first(), values / trace, rtol=1e-9)
    assert (found.groupby("vec_id").deviation.first().to_numpy() == deviation).all()
    assert set(found.n) == {300} and found.identity_error.max() < 1e-9


def test_equal_variances_are_all_found(spark):
    """One start vector meets one direction of a repeated variance; the others are searched afresh."""
    vectors = [(16 * s + j, [10.0 * (2 * s - 1) if i == j else 0.0 for i in range(8)]) for j in range(8) for s in (0, 1)]
    found = whitening.by_component(whitening.whitened(spark, frame(spark, vectors))).toPandas()
    assert found.component.max() == 8 and np.allclose(found.explained, 1 / 8) and found.identity_error.max() < 1e-9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 2.0]), (7, [1.0, 3.0])]
    bad = [(2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [-inf, 0.0]), (8, []), (9, [1.0])]
    rows = whitening.whitened(spark, frame(spark, good + bad)).collect()
    assert sorted((r.vec_id or 0) for r in rows) == [0, 1, 1, 7]
    assert {r.n for r in rows} == {4} and all(len(r.whitened) == 2 for r in rows)
    assert rows[0].identity_error < 1e-9


def test_nothing_to_whiten(spark):
    """An empty table, a single vector and equal vectors have no component."""
    for vectors in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (2, [])]):
        assert whitening.by_component(whitening.whitened(spark, frame(spark, vectors))).count() == 0


def test_fewer_directions_than_entries(spark):
    vectors = [(i, [float(i), 2.0 * i, 7.0, float(i % 3)]) for i in range(20)]
    found = whitening.by_component(whitening.whitened(spark, frame(spark, vectors))).toPandas()
    assert found.component.max() == 2 and found.identity_error.max() < 1e-9


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.QUERIES["op13_whitening"](spark, folder).toPandas()
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    deviation, centred, values, axes, trace = dense(vectors, 32)
    assert len(found) == 32 * len(vectors) and found.identity_error.max() < 1e-9
    got = found.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in vectors]].to_numpy()
    want = centred @ axes / np.sqrt(values)
    assert np.allclose(np.abs((got * want).mean(axis=0)), 1, atol=1e-6)
    assert np.allclose(found.groupby("component").explained.first(), values / trace, rtol=1e-9)
