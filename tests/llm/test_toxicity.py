"""Toxicity: the label model against plain loops, and accuracy on rows held out."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tributary.llm import queries, toxicity

WORDS = "ka ku ki lo la ma na no schu das ich über été".split()
SCHEMA = "doc_id long, text string, votes int, toxic string"


def held_out(doc) -> bool:
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


def corpus():
    """A tenth of the texts holds words with a stem that others never have; some labels are wrong."""
    random.seed(2)
    docs, labels, truth = [], [], {}
    for i in range(1500):
        words = random.choices(WORDS, k=random.randint(3, 60))
        bad = i % 10 == 0
        if bad:
            words += [random.choice(["idiot", "scum"]) if i % 20 else f"grobul{random.choice(WORDS)}" for _ in range(2)]
        random.shuffle(words)
        docs.append((i, " ".join(words)))
        truth[i] = bad
        if i % 3:
            labels.append((i, int(bad) if random.random() > 0.02 else int(not bad)))
    return docs, labels, truth


def frames(spark, docs, labels):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA), spark.createDataFrame(
        [(d, x, 0) for d, x in labels], "doc_id long, toxic int, quality int"
    )


def test_finds_toxic_texts_of_all_kinds(spark):
    docs, labels, truth = corpus()
    rows = toxicity.scored(spark, *frames(spark, docs, labels)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1500))
    assert all(r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in own) >= 0.99 * len(own)
    assert all(r.predicted for r in own if truth[r.doc_id])


def test_labels_held_out_change_nothing(spark):
    docs, labels, _ = corpus()
    turned = [(d, 1 - x if held_out(d) else x) for d, x in labels]
    first, second = (toxicity.scored(spark, *frames(spark, docs, x)).collect() for x in (labels, turned))
    assert {r.doc_id: r.score for r in first} == {r.doc_id: r.score for r in second}


def test_units_and_counts(spark):
    """Terms and beginnings, counted over all texts of either label."""
    texts = [("Ab abcdef, ABCDEF abcdeg", 1), ("abcdef", 0), ("", 0), ("über", 1)]
    rows = spark.createDataFrame(texts, "text string, toxic int")
    found = {r.unit: (r.toxic, r.clean) for r in toxicity.unit_counts(rows).collect()}
    units = {t: {int(np.uint64(u).view(np.int64)) for u in own} for (t, _), (_, own, _) in zip(texts, toxicity.units_of([t.encode() for t, _ in texts]))}
    assert [n for _, _, n in toxicity.units_of([b"Ab abcdef, ABCDEF abcdeg", b""])] == [4, 0]
    # ab, abcdef, abcdeg and the beginning abcd; words of six bytes have no beginning of six.
    assert len(units[texts[0][0]]) == 4 and len(units["abcdef"]) == 2
    for unit, counts in found.items():
        assert counts == tuple(sum(unit in units[t] for t, x in texts if x == y) for y in (1, 0))
    assert set(found) == set().union(*units.values())


def test_expected_counts_and_posterior(spark):
    """One round of the label model over a table of patterns equals loops over its rows."""
    rng = np.random.default_rng(1)
    states = rng.integers(0, 3, (40, toxicity.VOTERS))
    votes = (states << (2 * np.arange(toxicity.VOTERS))).sum(axis=1)
    label, count = rng.integers(-1, 2, 40), rng.integers(1, 9, 40)
    rows = spark.createDataFrame(list(zip(votes.tolist(), label.tolist(), count.tolist())), "votes long, label int, count long").repartition(3)
    model = toxicity.LabelModel()
    for step in range(3):
        toxic = model.toxic(states, label)
        pairs, labels = model.expected(rows)
        wide = toxicity.VOTERS * toxicity.STATES
        want, want_labels = np.zeros((2, wide, wide)), np.zeros((2, 2))
        for s, a, c, t in zip(states, label, count, toxic):
            at = s + 3 * np.arange(toxicity.VOTERS)
            for y, p in ((0, 1 - t), (1, t)):
                want[y][np.ix_(at, at)] += c * p
                if a >= 0:
                    want_labels[y, a] += c * p
        assert np.allclose(pairs, want) and np.allclose(labels, want_labels)
        if step == 1:
            model.correlate(pairs, 0.0)
            assert (model.parent >= 0).sum() == toxicity.VOTERS - 1
        model.update(pairs, labels)
    # The posterior by Bayes' rule, state by state.
    for s, a, got in zip(states, label, model.toxic(states, label)):
        p = model.prior.copy()
        for j in range(toxicity.VOTERS):
            for y in (0, 1):
                p[y] *= model.tables[j][y, s[model.parent[j]] if model.parent[j] >= 0 else 0, s[j]]
        if a >= 0:
            p *= model.label[:, a]
        assert got == pytest.approx(p[1] / p.sum(), rel=1e-6, abs=1e-12)


def test_odd_rows(spark):
    docs, labels, _ = corpus()
    odd = [(9001, None), (9002, ""), (9003, " \n"), (None, "idiot scum"), (None, None), (9004, "x" * 200_000), (9005, "scum idiot " * 40_000), (9005, "ka ku")]
    more = [(None, 1), (9001, None), (9002, 7), (9003, 0), (9003, 1), (7, 1), (7, 0)]
    rows = toxicity.scored(spark, *frames(spark, docs + odd, labels + more)).collect()
    assert len(rows) == len(docs) + len(odd)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(not r.held_out for r in by_id[None]) and sorted(r.predicted for r in by_id[None]) == [0, 1]
    assert by_id[9001][0].predicted == by_id[9002][0].predicted == by_id[9003][0].predicted == 0
    assert sorted(r.predicted for r in by_id[9005]) == [0, 1]


def test_without_labels_or_documents(spark):
    docs, labels, truth = corpus()
    rows = toxicity.scored(spark, *frames(spark, docs, [])).collect()
    # Fixed lexicons alone: texts with their words rank above all others.
    found = [r.score for r in rows if truth[r.doc_id] and r.doc_id % 20]
    assert len(rows) == 1500 and min(found) > max(r.score for r in rows if not truth[r.doc_id])
    assert toxicity.scored(spark, *frames(spark, [], labels)).count() == 0


def test_query_on_rows_held_out(spark):
    folder = "/root/testdata/sf0.1"
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").collect()}
    rows = queries.QUERIES["op11_toxicity"](spark, folder).collect()
    assert len(rows) == 10_000
    own = [r for r in rows if r.held_out and r.doc_id in label]
    toxic = [r for r in own if label[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.predicted for r in own if not label[r.doc_id]) <= 0.01 * len(own)
