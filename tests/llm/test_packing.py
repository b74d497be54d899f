from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_every_piece_once_and_few_bins(seed):
    random.seed(seed)
    capacity = random.choice([10, 64, 512])
    histogram = Counter(min(capacity, max(1, int(random.lognormvariate(3, 1)))) for _ in range(random.choice([5, 500, 20000])))
    combinations = packing.plan(dict(histogram), capacity)
    used, bins = Counter(), 0
    for chosen, times in combinations:
        assert 0 < sum(n * k for n, k in chosen) <= capacity
        bins += times
        for n, k in chosen:
            used[n] += k * times
    assert used == histogram
    total = sum(n * k for n, k in histogram.items())
    # No plan can do with fewer; first-fit decreasing is a plan for comparison.
    assert bins >= -(-total // capacity)
    free: list[int] = []
    for n in sorted(histogram.elements(), reverse=True):
        for i, space in enumerate(free):
            if space >= n:
                free[i] -= n
                break
        else:
            free.append(capacity - n)
    assert bins <= len(free)


def test_fullest_combination_against_all_subsets():
    random.seed(9)
    for _ in range(200):
        items = [(random.randint(1, 12), random.randint(1, 3)) for _ in range(4)]
        items = list(dict(items).items())
        space = random.randint(0, 30)
        sums = {0}
        for n, k in items:
            sums = {s + n * i for s in sums for i in range(k + 1)}
        chosen = packing.fullest(items, space)
        assert sum(n * k for n, k in chosen) == max(s for s in sums if s <= space)
        assert all(k <= dict(items)[n] for n, k in chosen)


def test_plan_of_nothing():
    assert packing.plan({}, 10) == []


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pieces_and_places(spark, capacity):
    random.seed(10)
    rows = [(i % 40 if i % 13 else None, " ".join(random.choices("the of and cat dog".split(), k=random.randint(0, 60))), 1) for i in range(300)]
    rows += [(1000, None, 1), (1001, "", 1), (1002, "word " * 9000, 1), (1002, "word " * 9000, 2)] + [(7, "hot text", 1)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(5)
    found = packing.packed(spark, docs, PATH, capacity).collect()
    plain = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text, _ in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            want[doc, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= capacity
    total = sum(r.length for r in found)
    assert len(sequences) <= -(-total // capacity) * 1.02 + 1


def test_empty_table(spark):
    assert packing.packed(spark, spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
