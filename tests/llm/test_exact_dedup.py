from __future__ import annotations

import random
from collections import Counter

import brute
import pytest

from tributary.llm import exact_dedup
from tributary.llm.storage import join_path, open_folder
from tributary.session import scratch_dir

SCHEMA = "doc_id long, text string"


def decisions(spark, rows, **limits):
    out = exact_dedup.decided(spark, spark.createDataFrame(rows, SCHEMA), **limits)
    return [(r[0], r[-1].keep_id, r[-1].size, bytes(r[-1].digest).hex(), r[-1].kept) for r in out.collect()]


def rows_with_copies():
    random.seed(3)
    texts = [None, "", "A", "a", "É", "é", "x" * 5000, *("w" * random.randint(1, 40) + random.choice("abC") for _ in range(60))]
    return [(random.randint(0, 200) if i % 9 else None, random.choice(texts)) for i in range(400)] + [(5, "hot")] * 200


@pytest.mark.parametrize("limits", [{}, {"table_bytes": 1500, "fanout": 2}, {"table_bytes": 1}])
def test_equals_brute_force(spark, limits):
    rows = rows_with_copies()
    found = decisions(spark, rows, **limits)
    assert sorted((f[:4] for f in found), key=str) == sorted(brute.exact(rows), key=str)
    kept = Counter(f[3] for f in found if f[4])
    assert set(kept.values()) == {1} and set(kept) == {f[3] for f in found}
    assert all(f[0] == f[1] for f in found if f[4])


def test_spill_files_are_removed_and_groups_are_whole(spark):
    files, root = open_folder(scratch_dir(spark, "grace-test"))
    records = [(b"%d" % (i % 50), i, 1, 1) for i in range(1000)]
    found = list(exact_dedup.grace(iter(records), files, root, table_bytes=300, fanout=3))
    assert {e[0]: (e[1], e[3]) for e in found} == {b"%d" % k: (950 + k, 20) for k in range(50)}
    from pyarrow import fs

    left = files.get_file_info(fs.FileSelector(join_path(root), recursive=True))
    assert left == []


def test_equal_hashes_do_not_merge_different_contents(monkeypatch):
    monkeypatch.setattr(exact_dedup.xxhash, "xxh3_64_intdigest", lambda content, seed=0: 7)
    table = exact_dedup.ContentTable()
    for i in range(3000):
        table.add((b"%d" % (i % 30), i, 1, 1))
    assert len(table.entries) == 30 and {e[3] for e in table.entries} == {100}


def test_all_columns_are_kept_and_names_may_clash(spark):
    rows = [(1, "A", 1, "x"), (2, "a", 2, "y"), (2, "a", 3, "z"), (3, None, 4, None), (4, "", 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int, `group` string")
    kept = exact_dedup.deduplicated(spark, docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4]


def test_empty_table(spark):
    assert decisions(spark, []) == []
