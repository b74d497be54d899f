"""Ranked lexical search against plain loops."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tributary.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    """(item_id, rank, doc_id, score), documents with a null id last of their score."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    documents, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            n = sum(c.values())
            score = 0
            for t in set(terms(text)) & set(c):
                m = 50 + 50 * n * documents // total
                score += math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def check(spark, docs, items, k):
    docs_frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, score int, terms string")
    items_frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    found = lexical.ranked(spark, docs_frame, items_frame, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain(docs, items, k), key=key)


def corpus(size):
    random.seed(3)
    words = [f"w{int(random.paretovariate(0.7)) % 3000}" for _ in range(20_000)]
    docs = [(i, " ".join(random.choices(words, k=random.randint(1, 60)))) for i in range(size)]
    docs += [(size + i, docs[i % 7][1]) for i in range(40)]
    return docs, [(i, " ".join(random.choices(words, k=random.choice([1, 5, 40])))) for i in range(25)]


@pytest.mark.parametrize("block, short, docs_in_segment", [(256, 64, 2048), (4, 1, 60), (2, 0, 25)])
def test_against_plain_loops(spark, monkeypatch, block, short, docs_in_segment):
    """Many small segments, so that thresholds come from some of them."""
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "SHORT", short)
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", docs_in_segment)
    monkeypatch.setattr(lexical, "SEEDS", 3)
    docs, items = corpus(600)
    check(spark, docs, items, 10)


def test_waves(spark, monkeypatch):
    monkeypatch.setattr(lexical, "WAVE_BYTES", 800)
    docs, items = corpus(100)
    check(spark, docs, items, 5)


def test_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, " .,"), (4, "Äpfel äpfel ÄPFEL"), (5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "A-B_c"),
        (6, "x " * 50_000 + "a"), (7, "日本 a1"), (8, "a" * 100_000),
    ]
    items = [(1, "a"), (2, None), (3, ""), (None, "b c"), (4, "äpfel"), (4, "x 日本"), (9, "no such"), (10, "a" * 100_000)]
    check(spark, docs, items, 3)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")], 3)
    check(spark, [(1, "a")], [], 3)
    check(spark, [(1, None)], [(1, "a")], 3)


def test_summaries_bound_and_skip(monkeypatch):
    """No summary is below a score, and most blocks that cannot matter are not scored."""
    monkeypatch.setattr(lexical, "BLOCK", 64)
    monkeypatch.setattr(lexical, "SHORT", 8)
    rng = np.random.default_rng(5)
    sizes = rng.integers(5, 40, 2000)
    topics = np.sort(rng.integers(0, 20, 2000))
    rows = [np.unique((topics[i] * 50 + rng.integers(0, 60, s)) % 1000) for i, s in enumerate(sizes)]
    ends = np.cumsum([len(r) for r in rows])
    flat = np.concatenate(rows)
    impacts = rng.integers(1, 999_999, len(flat))
    own = lexical.Segment.build(list(range(2000)), ends, flat, impacts)
    # As it comes back from its stored form.
    own = lexical.Segment.read(own.row(0).to_pylist()[0])
    scored = 0
    for _ in range(50):
        topic = int(rng.integers(0, 20))
        terms_ = np.unique((topic * 50 + rng.integers(0, 60, 12)) % 1000)
        weight = np.zeros(1000, np.int64)
        weight[terms_] = rng.integers(1, 9000, len(terms_))
        every = own.scores(np.arange(2000), weight)
        for block in range(len(own.block_lists)):
            members = own.places[own.block_starts[block] : own.block_ends[block]]
            assert own.bounds(np.array([block]), weight)[0] >= every[members].max()
        places, scores, count = own.best(terms_, weight, 5, 0)
        best = np.sort(every)[::-1][:5]
        assert (np.sort(scores)[::-1][:5] == best[best > 0]).all()
        scored += count
    assert scored < 0.5 * 50 * 2000
