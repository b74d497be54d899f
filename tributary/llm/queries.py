"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, exact_dedup, jaccard, language, lexical, packing, quality_model, quality_rules, suffix_dedup, toxicity, url_filters, warc, whitening
from tributary.llm.storage import importable


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.round_trip(spark, table(spark, folder, "pages"), least_bytes=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.packed(spark, docs, TOKENIZER, capacity=4096, closing_id=1, words_kept=400_000)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = exact_dedup.decided(spark, docs)
    found = F.col(rows.columns[-1])
    return rows.select(
        "doc_id",
        found["keep_id"].alias("keep_id"),
        found["size"].alias("group_size"),
        found["kept"].alias("kept"),
        F.lower(F.hex(found["digest"])).alias("text_sha256"),
    )


def op4_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked(spark, table(spark, folder, "documents"), words=3, percent=90)


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    rows = language.identified(spark, docs, language.train(docs))
    found = F.col(rows.columns[-1])
    return rows.select(
        "doc_id",
        language.held_out().alias("held_out"),
        found["lang_pred"].alias("lang_pred"),
        found["score"].alias("score"),
        found["rejected"].alias("rejected"),
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.marked(spark, table(spark, folder, "documents"), length=400, with_text=True).drop("spans")


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: the table has no dates, so a page's id gives its day."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """Lists over the hosts of the pages: blocked hosts that come and go, some domains, some allowed parts."""
    start = F.lit("2024-01-01").cast("date")
    hosts = pages.select(url_filters.host_of(F.col("url")).alias("host"), "page_id").filter("host <> ''")
    first = hosts.groupBy("host").agg(F.min("page_id").alias("m"))
    domains = first.withColumn("host", F.substring_index("host", ".", -2)).groupBy("host").agg(F.min("m").alias("m"))

    def event(rows: DataFrame, name: str, pattern: F.Column, day: F.Column, action: str) -> DataFrame:
        at = F.date_add(start, day.cast("int"))
        return rows.select(F.lit(name).alias("list"), pattern.alias("pattern"), at.alias("at"), F.lit(action).alias("action"))

    m, host = F.col("m"), F.col("host")
    return (
        event(first, "block", host, m % 300, "add")
        .unionAll(event(first, "block", host, m % 300 + 30 + m % 60, "remove"))
        .unionAll(event(first.filter(m % 3 == 0), "block", host, m % 300 + 200, "add"))
        .unionAll(event(domains.filter(m % 2 == 0), "block", host, F.lit(250), "add"))
        .unionAll(event(first.filter(m % 4 == 1), "allow", F.concat(host, F.lit("/en")), F.lit(100), "add"))
    )


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    rows = url_filters.decided(dated_captures(pages), dated_lists(pages))
    found = F.col(rows.columns[-1])
    return rows.select(
        "page_id", "url", "fetched_on",
        found["list"].alias("list"), found["pattern"].alias("pattern"), found["since"].cast("date").alias("since"), found["kept"].alias("kept"),
    )


def op9_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.scored(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded(spark, table(spark, folder, "documents"), TOKENIZER)


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(spark, table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=50)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.by_component(whitening.whitened(spark, table(spark, folder, "embeddings"), count=32))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_jaccard": op4_jaccard,
    "op5_language": op5_language,
    "op6_quality_rules": op6_quality_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_quality_model": op9_quality_model,
    "op10_bpe": op10_bpe,
    "op11_toxicity": op11_toxicity,
    "op12_lexical": op12_lexical,
    "op13_whitening": op13_whitening,
}

# Payload and SHA-1 of a page; base32 takes five bits at a time from two hex digits.
_WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         sha256(coalesce(html, '')) AS content, url
  FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY content) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
    ((position(substr(h, CAST(5 * i // 4 + 1 AS INTEGER), 1) IN '0123456789abcdef') - 1) * 16
      + position(substr(h, CAST(5 * i // 4 + 2 AS INTEGER), 1) IN '0123456789abcdef') - 1)
    // CASE i % 4 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END % 32) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to,
  url AS target_uri
FROM t
"""

_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles
  FROM w),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS root FROM s UNION SELECT y, root FROM reached JOIN links ON doc_id = x)
SELECT s.doc_id, len(shingles) AS n_shingles, (SELECT min(root) FROM reached r WHERE r.doc_id = s.doc_id) AS component_id
FROM s
"""

_EXACT = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM t WINDOW g AS (PARTITION BY t)
"""

_URLS = r"""
WITH c AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS DATE) AS fetched_on,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', '') AS host,
    lower(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)) AS path
  FROM pages),
first AS (SELECT host, min(page_id) AS m FROM c WHERE host <> '' GROUP BY host),
domains AS (SELECT array_to_string(split(host, '.')[-2:], '.') AS host, min(m) AS m FROM first GROUP BY 1),
events AS (
  SELECT 'block' AS list, host AS pattern, m % 300 AS day, 'add' AS action FROM first
  UNION ALL SELECT 'block', host, m % 300 + 30 + m % 60, 'remove' FROM first
  UNION ALL SELECT 'block', host, m % 300 + 200, 'add' FROM first WHERE m % 3 = 0
  UNION ALL SELECT 'block', host, 250, 'add' FROM domains WHERE m % 2 = 0
  UNION ALL SELECT 'allow', host || '/en', 100, 'add' FROM first WHERE m % 4 = 1),
single AS (
  SELECT list, pattern, CAST(DATE '2024-01-01' + CAST(day AS INTEGER) AS DATE) AS since, max(action) AS action
  FROM events GROUP BY ALL),
valid AS (
  SELECT list, pattern, since, action, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS until FROM single),
hits AS (
  SELECT c.page_id, v.list, v.pattern, v.since,
    row_number() OVER (PARTITION BY c.page_id ORDER BY length(v.pattern) DESC, v.list <> 'allow', v.list) AS place
  FROM c JOIN valid v ON v.action = 'add' AND c.fetched_on >= v.since AND (v.until IS NULL OR c.fetched_on < v.until)
    AND (c.host = v.pattern OR ends_with(c.host, '.' || v.pattern) OR starts_with(c.host || c.path || '/', v.pattern || '/')))
SELECT c.page_id, c.url, c.fetched_on, h.list, h.pattern, h.since, coalesce(h.list = 'allow', true) AS kept
FROM c LEFT JOIN hits h ON h.page_id = c.page_id AND h.place = 1
"""

_LEXICAL = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
held AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
frequency AS (SELECT term, count(*) AS df FROM held GROUP BY term),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN frequency USING (term) JOIN d USING (doc_id), total
  GROUP BY item_id, doc_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 50
"""

SQL: dict[str, str] = {
    "op1_warc": _WARC,
    "op3_exact_dedup": _EXACT,
    "op4_jaccard": _JACCARD,
    "op8_url_filters": _URLS,
    "op12_lexical": _LEXICAL,
}
