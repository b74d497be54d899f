"""Registered queries against their SQL or against brute force, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import os
from collections import Counter

import brute
import compare
import corpus_pipeline
import pytest

from tributary.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare.difference(queries.QUERIES[name](spark, FOLDER), duck, queries.SQL[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_jaccard_query(spark):
    found = queries.QUERIES["op4_jaccard"](spark, FOLDER).collect()
    assert sorted(map(tuple, found)) == sorted(brute.linked(documents(spark), 3, 90))


def test_suffix_query(spark):
    found = queries.QUERIES["op7_suffix_dedup"](spark, FOLDER).collect()
    assert sorted(tuple(r)[:5] for r in found) == sorted(brute.suffix(documents(spark), 400))
    # The kept text is what the digest is of, unless a character was cut through.
    whole = [r for r in found if hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256]
    assert len(whole) >= 0.9 * len(found) and any(r.n_removed for r in whole)
    assert all(r.n_bytes - r.n_removed - 3 * 2 * r.n_spans <= len(r.text.encode()) <= r.n_bytes - r.n_removed for r in found)


def test_quality_rules_query(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op6_quality_rules"](spark, FOLDER).collect()}
    for doc, text in documents(spark):
        r, (words, chars, symbols, lines, repeats) = found[doc], brute.quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (words, chars, symbols, lines, repeats)
        assert r.base_failed == (words < 50 or 100 * repeats > 50 * words) and not (r.base_failed and r.kept)


@pytest.mark.parametrize("name", ["op2_packing", "op5_language", "op9_quality_model", "op10_bpe", "op11_toxicity"])
def test_queries_cover_every_document(spark, name):
    found = {r.doc_id for r in queries.QUERIES[name](spark, FOLDER).select("doc_id").collect()}
    assert found == {d for d, _ in documents(spark)}


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, documents(spark)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == {d for d, _ in before}
            return
        assert docs.columns == columns
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "language":
            assert set(after) <= set(before) and len(after) >= 0.98 * len(before)
        elif name == "exact_dedup":
            assert sorted(after) == sorted((d, t) for (d, t), (_, keep, _, _) in zip(before, brute.exact(before)) if d == keep)
        elif name == "near_dedup":
            _, groups = brute.components(before, 5, 80)
            assert sorted(d for d, _ in after) == sorted(min(before[i][0] for i in g) for g in groups)
        else:
            data = [(t or "").encode() for _, t in before]
            covered = brute.repeated(data, corpus_pipeline.REPEATED_BYTES)
            kept = [bytes(b for b, c in zip(t, f) if not c).decode(errors="ignore") for t, f in zip(data, covered)]
            assert Counter(after) == Counter((d, k) for (d, _), k in zip(before, kept))
        before = after


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
