from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from tributary.llm import components, jaccard
from tributary.llm.text import hashed_words

SCHEMA = "doc_id long, text string"


def near_copies(seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[random.choice(words) for _ in range(random.choice([1, 2, 5, 20, 60, 200]))] for _ in range(20)]
    rows = []
    for i in range(160):
        own = list(random.choice(bases[:3] if i % 3 else bases))
        for _ in range(random.choice([0, 0, 1, 1, 2, 3, 6])):
            own[random.randrange(len(own))] = random.choice(words)
        rows.append((i if i % 17 else None, " ".join(own)))
    return rows + [(900, None), (901, ""), (902, " \n"), (3, "A b"), (3, "a B"), (904, "a b c"), (905, "a b c a b c")]


@pytest.mark.parametrize(("seed", "words", "percent", "most"), [(1, 3, 90, 3000), (2, 5, 80, 3000), (3, 1, 60, 15)])
def test_equals_brute_force(spark, seed, words, percent, most):
    rows = near_copies(seed)
    found = jaccard.linked(spark, spark.createDataFrame(rows, SCHEMA), words, percent, most).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute.linked(rows, words, percent), key=str)


def test_one_row_of_each_component_stays(spark):
    rows = [(d, t, i) for i, (d, t) in enumerate(near_copies(4))]
    rows += [(1000, "same text here of five words", 1), (1000, "same text here of five words", 2)]
    docs = spark.createDataFrame(rows, SCHEMA + ", least int")
    kept = jaccard.representatives(spark, docs, 3, 80)
    assert kept.schema == docs.schema
    ids = [(r.doc_id, r.least) for r in kept.collect()]
    sets, groups = brute.components([r[:2] for r in rows], 3, 80)
    alone = sum(1 for s in sets if not s)
    assert len(ids) == sum(1 for g in groups if sets[g[0]]) + alone
    for group in groups:
        known = [rows[i][0] for i in group if rows[i][0] is not None]
        stay = [i for i in group if (rows[i][0], rows[i][2]) in ids]
        if sets[group[0]] and known:
            assert [rows[i][0] for i in stay] == [min(known)]


def test_texts_are_hashed_once(spark):
    rows = [(i, text) for i, (_, text) in enumerate(near_copies(5))]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(rows, SCHEMA).mapInArrow(counted, SCHEMA)
    assert 0 < len(jaccard.representatives(spark, docs, 3, 80).collect()) < len(rows)
    # For the sets, for the complete sets of candidates, and for the rows that stay.
    assert read.value <= 3 * len(rows)
    plan = jaccard.linked(spark, docs, 3, 80)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_tree_finds_every_partner_that_the_bound_allows():
    random_ = np.random.default_rng(5)
    sets = [np.unique(random_.integers(0, 2**63, n, dtype=np.uint64)) for n in random_.integers(5, 400, 60)]
    for base in list(sets[:20]):
        for lost in (1, 3, 10):
            sets.append(np.unique(np.concatenate([base[lost:], random_.integers(0, 2**63, lost, dtype=np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    points = np.array([jaccard.point(s) for s in sets])
    ids = np.arange(len(sets))
    pairs = set(jaccard.bucket_pairs(ids, sizes, points, ids, np.zeros(len(ids), int), 80, False))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            bound = np.minimum(points[a], points[b]).sum()
            fits = 180 * bound >= 80 * (sizes[a] + sizes[b]) and 100 * min(sizes[a], sizes[b]) >= 80 * max(sizes[a], sizes[b])
            assert ((a, b) in pairs) == fits
    forest = set(jaccard.bucket_pairs(ids, sizes, points, ids, np.zeros(len(ids), int), 80, True))
    assert forest <= pairs and len(forest) < len(ids)


def test_components_of_paths_and_stars(spark):
    random.seed(6)
    path = [(i, i + 1) for i in range(100)]
    star = [(500, i) for i in range(200, 300)]
    edges = path + star + [(700, 701), (701, 700), (9, 9)]
    random.shuffle(edges)
    found = components.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert roots == {**dict.fromkeys(range(101), 0), **dict.fromkeys([*range(200, 300), 500], 200), 700: 700, 701: 700}


def test_empty_table(spark):
    assert jaccard.linked(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_pairs_of_blocks_are_told_apart_by_their_numbers(spark):
    """No hash of them: two pairs of blocks never become one search."""
    rows = spark.range(60).selectExpr("7L AS bucket", "id", "100L + id % 3 AS n", "60L AS members")
    found = jaccard._searches(spark, rows, 80, 10)
    assert found.columns[:5] == ["search", "c", "d", "i", "j"]
    for r in found.groupBy("search", "c", "d", "i", "j").agg({"side": "max", "id": "count"}).collect():
        assert r["max(side)"] == int((r.c, r.i) != (r.d, r.j))


def edited_copies(count, edits, length=120, seed=11):
    """Texts that differ from one original by some words each: many pairs are a little below the limit."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(length)]
    rows = []
    for i in range(count):
        own = list(words)
        for place in pick.sample(range(length), pick.choice(edits)):
            own[place] = f"x{i}-{place}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("most_members", [3000, 20])
def test_many_pairs_a_little_below_the_limit(spark, most_members):
    rows = edited_copies(150, [0, 1, 2, 3])
    found = jaccard.linked(spark, spark.createDataFrame(rows, SCHEMA), words=3, percent=90, most_members=most_members)
    want = {r[0]: r for r in brute.linked(rows, 3, 90)}
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in want.values()}


def test_verified_search_emits_a_forest_of_true_links():
    rows = edited_copies(200, [0, 1, 2, 3, 4])
    sets = [jaccard.shingle_set(hashes, 3) for _, hashes in hashed_words([t.encode() for _, t in rows], True)]
    ids, sizes = np.arange(200), np.array(list(map(len, sets)))
    points = np.array([jaccard.point(s) for s in sets], np.int32)
    found = list(jaccard.bucket_pairs(ids, sizes, points, ids.copy(), np.zeros(200, int), 90, True, sets))
    linked = {(a, b) for a in range(200) for b in range(a) if 190 * len(np.intersect1d(sets[a], sets[b])) >= 90 * (sizes[a] + sizes[b])}
    assert all((max(p), min(p)) in linked for p in found) and len(found) < 200 < len(linked)
    root = list(range(200))
    for a, b in found:
        old, new = root[a], root[b]
        root = [new if r == old else r for r in root]
    assert all(root[a] == root[b] for a, b in linked)
