"""Language identification, quality rules and quality classifier."""

from __future__ import annotations

import os
import random

import brute
import numpy as np
import pytest

from tributary.llm import language, quality_model, quality_rules

FOLDER = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
ODD = [None, "", " \n", "123 !!", "x", "x" * 50_000, "é è", "日本語", "\U0001d518 ́"]


def small_languages(spark):
    random.seed(1)
    words = {"aa": "ka ku ki lo la ma".split(), "bb": "sch ein der das och".split()}
    rows = []
    for i in range(400):
        lang = ["aa", "bb"][i % 2]
        rows.append((i, " ".join(random.choices(words[lang], k=30)), lang, i))
    rows += [(1000 + i, t, None, 0) for i, t in enumerate(ODD)] + [(None, "ka lo ma", "aa", 0), (5, "ka lo ma la", "aa", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, language int"), rows


def test_models_are_distributions(spark):
    docs, _ = small_languages(spark)
    model = language.train(docs)
    symbols = np.unique(language.folded(["ka ku ki lo la ma sch ein der das och"])[0] & np.uint64(0xFFFF))
    for text in ("ka l", "ein ", "och s", "zzzz"):
        context = language.folded([text])[0][-1] >> np.uint64(16) << np.uint64(16)
        sums = np.exp(model.log_probabilities(context | symbols)).sum(axis=0)
        # What is left belongs to symbols that no language has.
        assert (sums < 1.001).all() and (sums > 0.5).all()


def test_unseen_grams_are_backed_off_alike_in_sorted_arrays(spark):
    docs, _ = small_languages(spark)
    model = language.train(docs)
    table = model.tables[-1]
    keys = np.random.default_rng(2).integers(0, 2**63, 2000, dtype=np.uint64)
    assert (table.find(keys) == -1).all()
    known = np.sort(language.folded(["ka ku ki"])[0])
    places = table.find(known)
    assert (places >= 0).all() and (table.hashes[places] == language.mix(known)).all()


def test_no_gram_is_cut(spark, monkeypatch):
    """All grams count, however many values of lang there are; probabilities are those of plain loops."""
    monkeypatch.setattr(language, "PART_NUMBERS", 1 << 8)
    monkeypatch.setattr(language, "CACHE_BYTES", 1 << 12)
    random.seed(7)
    texts = {x: ["".join(random.choices("abcdefghijkl ", k=60)) for _ in range(60)] for x in ("aa", "bb")}
    rows = [(i, t, x) for x, own in texts.items() for i, t in enumerate(own) if not brute.held_out(i)]
    strays = [(None, "stray", f"x{i}") for i in range(2000)]
    model = language.train(spark.createDataFrame(rows + strays, "doc_id long, text string, lang string"))
    assert model.langs == ["aa", "bb"]
    grams = np.unique(language.folded([t for _, t, _ in rows])[0])
    assert len(grams) > 1000 and (model.tables[-1].find(grams) >= 0).all()
    keys = np.append(grams, np.random.default_rng(1).integers(0, 2**63, 50, dtype=np.uint64))
    want = brute.kneser_ney([(x, language.folded([t])[0].tolist()) for _, t, x in rows], keys.tolist())
    assert np.allclose(model.log_probabilities(keys), want, atol=1e-3)


def test_small_languages_reject_too(spark):
    """A language with a handful of documents has the limit of all documents together."""
    random.seed(8)
    words = {"aa": "ka ku ki lo la ma".split(), "bb": "sch ein der das och".split(), "cc": "zu zo zi wu wo".split()}
    langs = ["aa"] * 600 + ["bb"] * 600 + ["cc"] * 8
    rows = [(i, " ".join(random.choices(words[lang], k=30)), lang) for i, lang in enumerate(langs)]
    rows += [(5000 + i, "".join(chr(random.randint(0x4E00, 0x5E00)) for _ in range(200)), None) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert np.isfinite(model.limit).all()
    found = language.identified(spark, docs, model).collect()
    assert all(r[-1].rejected for r in found if r.doc_id >= 5000)
    assert all(r[-1].lang_pred == r.lang for r in found if r.lang)
    assert not any(r[-1].rejected for r in found if r.lang in ("aa", "bb"))


def test_languages_odd_texts_and_clashing_columns(spark):
    docs, rows = small_languages(spark)
    out = language.identified(spark, docs, language.train(docs))
    assert out.columns[:4] == docs.columns and out.count() == len(rows)
    found = out.collect()
    for r in found:
        guess = r[-1]
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (guess.lang_pred, guess.score, guess.rejected) == ("und", 0.0, True)
        else:
            assert guess.lang_pred in ("aa", "bb") and 0 <= guess.score <= 1
        if r.lang and r.doc_id is not None:
            assert guess.lang_pred == r.lang and not guess.rejected


def test_nothing_to_learn_and_empty_tables(spark):
    none = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [r[-1].lang_pred for r in language.identified(spark, none, language.train(none)).collect()] == ["und"]
    empty = none.limit(0)
    assert language.identified(spark, empty, language.train(empty)).collect() == []


@given
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language.identified(spark, docs, language.train(docs)).collect()
    assert {r.doc_id for r in found if brute.held_out(r.doc_id)}
    aside = [r for r in found if brute.held_out(r.doc_id) and r.lang]
    assert sum(r[-1].lang_pred == r.lang for r in aside) > 0.97 * len(aside)
    assert sum(r[-1].rejected for r in found) < 0.01 * len(found)


def test_counts_of_rules_equal_brute_force():
    random.seed(3)
    pool = ["a", "B", "the", "é", "#", "x|y", "\n", "\n", " ", "\t", "\x0b", "\x1c", " "]
    texts = ["".join(random.choice(pool) + random.choice(["", " ", "\n"]) for _ in range(random.randint(0, 80))) for _ in range(400)]
    texts += [t or "" for t in ODD] + ["a b c " * 30, "line\nline\n\n \nline"]
    counts, _ = quality_rules.statistics([t.encode() for t in texts])
    assert [tuple(c) for c in counts.tolist()] == [brute.quality(t) for t in texts]


def labelled(spark):
    random.seed(4)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(random.choices("abcdefghij", k=random.randint(2, 8))) for _ in range(80)]
        bad = i % 20 == 0
        rows.append((i, " ".join(w + random.choice(["###", "%%%"]) for w in words) if bad else " ".join(words), 1))
        labels.append((i, int(not bad)))
    rows += [(None, "null id " * 60, 0), (5, rows[5][1], 0), *((2000 + i, t, 0) for i, t in enumerate(ODD))]
    labels += [(None, 1), (1, None), (5, 1), (9999, 0)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, kept int"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
        rows,
    )


def test_forest_sets_junk_apart(spark):
    docs, labels, rows = labelled(spark)
    found = quality_rules.judged(spark, docs, labels, lost_good=0.05).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.n_words < 50:
            assert r.base_failed and not r.kept
    known = [r for r in found if r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5]
    good, junk = ([r.kept for r in known if (r.doc_id % 20 != 0) == g] for g in (True, False))
    assert sum(good) >= 0.94 * len(good) and sum(junk) <= 0.2 * len(junk)


def test_rules_without_labels_or_rows(spark):
    docs, labels, rows = labelled(spark)
    free = quality_rules.judged(spark, docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in free) and len(free) == len(rows)
    assert quality_rules.judged(spark, docs.limit(0), labels).collect() == []


def test_rules_learn_from_every_row(spark):
    """The threshold is the quantile of all rows labelled good, and each tree draws from all rows."""
    random_ = np.random.default_rng(8)
    texts = [" ".join("x" * n for n in random_.integers(1, 12, 60)) for _ in range(9000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    labels = spark.range(9000).selectExpr("id AS doc_id", "1 AS quality")
    found = quality_rules.judged(spark, docs, labels, lost_good=0.05).collect()
    good = sorted(r.anomaly for r in found if not r.base_failed)
    assert len(good) > 8500
    assert {r.threshold for r in found} == {good[int(np.ceil(0.95 * len(good)))]}

    rows = quality_rules.measured(docs, 50, 50).filter("NOT base_failed")
    trees = quality_rules.drawn(rows, 100, 256, 1)
    once = quality_rules.drawn(rows.coalesce(1), 100, 256, 1)
    assert [len(t) for t in trees] == [256] * 100 and all(np.array_equal(a, b) for a, b in zip(trees, once))


def test_nth_smallest_is_exact(spark):
    values = np.random.default_rng(9).choice([0.1, 0.1 + 1e-16, 0.3, 0.30000000000000004, 0.7, 0.9], 500).tolist()
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert [quality_rules.nth_smallest(rows, "v", n, 3) for n in (0, 250, 499)] == [sorted(values)[n] for n in (0, 250, 499)]


def test_paths_are_shorter_for_rows_apart():
    rows = np.random.default_rng(5).normal(size=(500, 3))
    forest = quality_rules.Forest(np.vstack([rows, [[9, 9, 9]]]), 60, 128, 1)
    scores = forest.score(np.array([[9.0, 9, 9], [0, 0, 0]]))
    assert scores[0] > 0.6 > 0.5 > scores[1]
    assert float(quality_rules.usual_path(2)) == 1 and float(quality_rules.usual_path(1)) == 0


def test_classifier_scores(spark):
    docs, labels, rows = labelled(spark)
    found = quality_model.scored(spark, docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == brute.held_out(r.doc_id)
    aside = [r for r in found if r.held_out and r.doc_id < 600]
    assert sum(r.predicted == int(r.doc_id % 20 != 0) for r in aside) > 0.97 * len(aside)
    assert {r.score for r in quality_model.scored(spark, docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.scored(spark, docs.limit(0), labels).collect() == []


def test_dual_coordinate_descent_reaches_the_optimum():
    """The duality gap of the hinge loss closes."""
    random_ = np.random.default_rng(6)
    rows = [np.unique(random_.integers(0, 40, 8)) for _ in range(80)]
    good = np.array([(r < 20).mean() > 0.5 for r in rows])
    scale = np.ones(1 << quality_model.BITS)
    weights, bias = quality_model.dual_coordinate_descent(rows, scale, good, 1.0, 2000, 1)
    sign = np.where(good, 1.0, -1.0)
    cost = np.where(good, len(rows) / (2 * good.sum()), len(rows) / (2 * (~good).sum()))

    def primal(w, b):
        margins = np.array([w[r].sum() / np.sqrt(len(r)) + b for r in rows])
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - sign * margins)).sum()

    best = primal(weights, bias)
    for _ in range(200):
        step = random_.normal(size=1 << quality_model.BITS) * (np.arange(1 << quality_model.BITS) < 40) * 0.01
        assert primal(weights + step, bias + random_.normal() * 0.01) > best - 1e-3


@given
def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = quality_model.scored(spark, docs, labels).collect()
    aside = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in aside) > 0.9 * len(aside)
    rules = quality_rules.judged(spark, docs, labels).collect()
    passed = [r for r in rules if not r.base_failed and r.doc_id in truth]
    assert sum(r.kept for r in passed if truth[r.doc_id] == 1) > 0.98 * sum(truth[r.doc_id] == 1 for r in passed)
    assert sum(not r.kept for r in passed if truth[r.doc_id] == 0) > 0.5 * sum(truth[r.doc_id] == 0 for r in passed)


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no tables")
def test_rules_reject_labelled_junk(spark):
    """At the parameters of the query, on a table with hundreds of bad labels."""
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    passed = [r for r in quality_rules.judged(spark, docs, labels).collect() if not r.base_failed and r.doc_id in truth]
    junk = [r.kept for r in passed if truth[r.doc_id] == 0]
    assert len(junk) > 100 and sum(not k for k in junk) >= 0.8 * len(junk)
