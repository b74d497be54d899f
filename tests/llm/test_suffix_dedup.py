from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from tributary.llm import suffix_dedup

SCHEMA = "doc_id long, text string"


def passages(seed):
    random.seed(seed)

    def some(n, letters="abcdefgh é\n"):
        return "".join(random.choices(letters, k=n))

    bases = [some(random.randint(0, 300)) for _ in range(6)]
    rows = []
    for i in range(30):
        text = some(random.randint(0, 60))
        for _ in range(random.randint(0, 3)):
            base = random.choice(bases)
            a = random.randint(0, len(base))
            text += base[a : random.randint(a, len(base))] + some(random.randint(0, 20), "xyz")
        rows.append((i if i % 7 else None, text if i % 11 else None))
    # Runs of one symbol, repeated rows and ids.
    return rows + [(50, "a" * 300), (51, "ab" * 200), (51, "ab" * 200), (52, "a" * 299), (53, "")]


@pytest.mark.parametrize(
    ("seed", "length", "limits"),
    [(1, 8, {}), (2, 40, {}), (3, 40, {"most_contexts": 2}), (4, 24, {"most_contexts": 1})],
)
def test_equals_brute_force(spark, seed, length, limits):
    rows = passages(seed)
    found = suffix_dedup.marked(spark, spark.createDataFrame(rows, SCHEMA), length, **limits).drop("spans").collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute.suffix(rows, length), key=str)


def test_sorted_columns_find_all_repeated_windows():
    random_ = np.random.default_rng(7)
    rows = random_.integers(97, 99, (40, 60)).astype(np.uint8)
    rows[5, 10:50] = rows[20, 10:50]
    rows[7, :9] = suffix_dedup.OUTSIDE
    for length in (3, 8, 30):
        flags = suffix_dedup.repeated_offsets(rows, 0, 60 - length, length)
        for c in range(60 - length + 1):
            own = [bytes(r[c : c + length]) for r in rows]
            want = [own.count(w) > 1 and b"\xff" not in w for w in own]
            assert flags[:, c].tolist() == want


def test_long_texts_are_read_in_blocks(monkeypatch):
    random.seed(8)
    shape = suffix_dedup.Shape(40)
    text = "".join(random.choices("abcd", k=5000)).encode()
    whole = list(suffix_dedup.anchor_rows([text], shape))[0]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    parts = list(suffix_dedup.anchor_rows([text], shape))[0]
    assert all((a == b).all() for a, b in zip(whole[1:], parts[1:]))


def test_cleaned_keeps_columns_and_nulls(spark):
    shared = "".join(random.Random(9).choices("abcdefgh", k=100))
    rows = [(1, f"left é {shared} right", 1), (2, f"{shared}", 2), (3, None, 3), (None, "short", 4)]
    docs = spark.createDataFrame(rows, SCHEMA + ", windows int")
    out = suffix_dedup.cleaned(spark, docs, 80)
    assert out.schema == docs.schema
    assert {r.windows: r.text for r in out.collect()} == {1: "left é  right", 2: "", 3: None, 4: "short"}


def test_empty_table(spark):
    assert suffix_dedup.marked(spark, spark.createDataFrame([], SCHEMA), 40).collect() == []
