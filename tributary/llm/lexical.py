"""Ranked lexical search: the best documents for each item, over posting lists in geometric blocks.

Scores add, over an item's terms, a weight that falls with the number of documents that hold the term
and an impact that grows with the term's occurrences in the document and falls with its length; both are whole numbers.

The index covers the terms of the items. Documents lie in order of their similarity to a few
pivots and are cut into segments; in a segment each term's posting list follows that order and is cut into
blocks, so a block holds documents that are alike. A block stores for each term the largest impact
that a document of it has (a summary, rounded up). For an item,
* lists are opened from the strongest on; those left over are so weak that a document that has no other of the item's
  terms stays below the score that the item's result begins with (the threshold), and
* a block of an opened list is skipped if its summary bounds its documents below the threshold.
Everything else is scored on whole vectors, so the result is exact. Thresholds start from
the k-th best score in a few segments and rise with the segment's own results.

Every document is indexed; the sample of `PIVOTS` documents and `SEEDS` segments changes speed only. Items are
searched in waves of about `WAVE_BYTES` of item text, so what goes to all tasks is bounded.

A null text has no terms; an item or a document without terms has no rows. Rows with one doc_id rank each, a null doc_id
after others of its score; rows with one item_id are searched each. Terms are equal if their 64-bit hashes are.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.storage import importable, stored, utf8
from tributary.llm.text import BASE, NO_TERM, hashed_words, mix

WAVE_BYTES = 8 << 20
PIVOTS = 64
SIDES = 128  # length of the vectors that are compared with pivots
SEGMENT_DOCS, SEGMENT_ENTRIES = 2048, 1 << 18
BLOCK = 256
# Lists of so few documents are scored without asking a summary.
SHORT = 64
SEEDS = 16
# A summary's unit: 255 of them cover the largest impact.
STEP = 3922

VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
SEGMENT = (
    "pick int, docs array<long>, ends binary, terms binary, impacts binary, lists binary, list_ends binary, places binary, "
    "block_lists binary, block_starts binary, block_ends binary, summary_ends binary, summary_terms binary, summary_tops binary"
)


def ragged(ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of some rows of a ragged array, and where each row's entries begin among them."""
    starts = np.concatenate(([0], ends[:-1]))[rows]
    sizes = ends[rows] - starts
    begins = np.concatenate(([0], np.cumsum(sizes)))
    return np.repeat(starts - begins[:-1], sizes) + np.arange(begins[-1]), begins[:-1]


def packed(values: np.ndarray) -> bytes:
    """An array in the smallest type that holds it; the first byte is the size of the type."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    found = np.frombuffer(data, f"u{data[0]}", offset=1)
    return found if data[0] == 1 else found.astype(np.int32 if data[0] < 8 else np.int64)


def gaps(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rising rows of a ragged array as differences; the first of a row is kept."""
    out = np.diff(values, prepend=0)
    first = np.concatenate(([0], ends[:-1]))[np.diff(ends, prepend=0) > 0]
    out[first] = values[first]
    return out


def from_gaps(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.cumsum(values, dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    before = np.where(starts > 0, sums[starts - 1], 0) if len(sums) else starts
    return (sums - np.repeat(before, ends - starts)).astype(np.int32)


@dataclass
class Wave:
    """The items that are searched together: the sorted hashes of their terms, and each item's terms by number."""

    vocabulary: np.ndarray
    items: list
    terms: list[np.ndarray]


def waves(items: DataFrame) -> Iterator[Wave]:
    rows = items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / WAVE_BYTES))
    kind = rows.schema["item_id"].dataType.simpleString()

    def terms(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(h).view(np.int64) for _, h in hashed_words(utf8(batch.column("text")), True, gaps=NO_TERM)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(found, pa.list_(pa.int64()))], names=["item_id", "terms"]
            )

    for wave in range(count):
        own = rows.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == wave)
        found = own.mapInArrow(terms, f"item_id {kind}, terms array<long>").collect()
        found = [(r["item_id"], np.array(r["terms"], np.int64).view(np.uint64)) for r in found if r["terms"]]
        if found:
            vocabulary = np.unique(np.concatenate([t for _, t in found]))
            yield Wave(vocabulary, [i for i, _ in found], [np.searchsorted(vocabulary, t) for _, t in found])


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Of each document its terms in all, and the number and count of those in the vocabulary."""
    size = len(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches) -> Iterator[pa.RecordBatch]:
        known = shared.value
        # Most words are unknown: one bit of a table tells, without a search.
        maybe = np.zeros(1 << 20, bool)
        maybe[known >> np.uint64(44)] = True
        for batch in batches:
            n, keys = np.zeros(batch.num_rows, np.int64), []
            for i, words in hashed_words(utf8(batch.column("text")), True, gaps=NO_TERM):
                n[i] = len(words)
                words = words[maybe[words >> np.uint64(44)]]
                place = np.minimum(np.searchsorted(known, words), size - 1)
                keys.append(place[known[place] == words] + i * size)
            found, counts = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
            ends = np.searchsorted(found, np.arange(batch.num_rows + 1) * size).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n),
                    pa.ListArray.from_arrays(ends, pa.array((found % size).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, VECTORS)


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        known = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(total[known])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in rows.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def term_weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequencies], np.int64)


def impacts_of(counts: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The impact of terms that occur `counts` times in documents of `n` terms."""
    m = 50 + 50 * n * documents // total
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


def projected(batch_rows: int, ends: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors of `SIDES` signed sums: alike documents point alike."""
    spread = mix(terms.astype(np.uint64) * np.uint64(BASE) + np.uint64(1))
    doc = np.repeat(np.arange(batch_rows), np.diff(ends, prepend=0))
    sign = np.where(spread & np.uint64(SIDES), 1.0, -1.0)
    place = doc * SIDES + (spread & np.uint64(SIDES - 1)).astype(np.int64)
    sums = np.bincount(place, weights=sign * values, minlength=batch_rows * SIDES).reshape(batch_rows, SIDES)
    return sums / np.maximum(1e-9, np.linalg.norm(sums, axis=1, keepdims=True))


def lists_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends and entries of a list column without nulls."""
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return ends, column.flatten().to_numpy(zero_copy_only=False)


def in_order_of_similarity(rows: DataFrame, documents: int, total: int, weights: np.ndarray) -> DataFrame:
    """doc_id, terms, impacts and `near`: the numbers of the two pivots a document is nearest to."""
    spark = rows.sparkSession
    held = rows.filter(F.size("terms") > 0)
    order = F.xxhash64("terms", "counts", "doc_id")
    pivots = held.orderBy(order).limit(PIVOTS).select("n", "terms", "counts").collect()

    def vector(n, ends, terms, counts):
        impacts = impacts_of(counts.astype(np.int64), np.repeat(n, np.diff(ends, prepend=0)), documents, total)
        return impacts, projected(len(n), ends, terms, (weights[terms] * impacts).astype(float))

    own = [vector(np.array([p["n"]]), np.array([len(p["terms"])]), np.array(p["terms"]), np.array(p["counts"]))[1] for p in pivots]
    centres = np.concatenate(own) if own else np.zeros((1, SIDES))
    shared = spark.sparkContext.broadcast((weights, centres))

    def nearest(batches) -> Iterator[pa.RecordBatch]:
        weights, centres = shared.value
        for batch in batches:
            ends, terms = lists_in(batch.column("terms"))
            counts = batch.column("counts").flatten().to_numpy().astype(np.int64)
            n = batch.column("n").to_numpy()
            impacts = impacts_of(counts, np.repeat(n, np.diff(ends, prepend=0)), documents, total)
            likeness = projected(len(n), ends, terms, (weights[terms] * impacts).astype(float)) @ centres.T
            first = likeness.argmax(axis=1)
            likeness[np.arange(len(n)), first] = -2
            near = first * PIVOTS + likeness.argmax(axis=1)
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(offsets, pa.array(terms)),
                    pa.ListArray.from_arrays(offsets, pa.array(impacts.astype(np.int32))),
                    pa.array(near.astype(np.int32)),
                ],
                names=["doc_id", "terms", "impacts", "near"],
            )

    found = held.mapInArrow(nearest, "doc_id long, terms array<int>, impacts array<int>, near int")
    # Copies are as near as their originals: what tells them apart lets a large group lie in several partitions.
    spread = F.xxhash64(F.monotonically_increasing_id())
    return found.withColumn("spread", spread).repartitionByRange("near", "spread").sortWithinPartitions("near", "spread").drop("spread")


class Segment:
    """Documents with their vectors, the posting lists over them, and the blocks' summaries."""

    def __init__(self, docs, ends, terms, impacts, lists, list_ends, places, block_lists, block_starts, block_ends, *summary):
        self.docs, self.ends, self.terms, self.impacts = docs, ends, terms, impacts
        self.lists, self.list_ends, self.places = lists, list_ends, places
        self.block_lists, self.block_starts, self.block_ends = block_lists, block_starts, block_ends
        self.summary_ends, self.summary_terms, self.summary_tops = summary
        starts = np.concatenate(([0], list_ends[:-1]))
        self.sizes = list_ends - starts
        # Blocks of a list follow each other.
        self.first_block = np.searchsorted(block_lists, np.arange(len(lists) + 1))

    @classmethod
    def build(cls, docs: list, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> Segment:
        doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        order = np.argsort(terms, kind="stable")
        lists, sizes = np.unique(terms, return_counts=True)
        list_ends, places = np.cumsum(sizes), doc[order]
        blocks = -(-sizes // BLOCK)
        block_lists = np.repeat(np.arange(len(lists)), blocks)
        number = np.arange(len(block_lists)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = (list_ends - sizes)[block_lists] + number * BLOCK
        stops = np.minimum(starts + BLOCK, list_ends[block_lists])
        top = np.zeros(int(lists[-1]) + 1 if len(lists) else 0, np.uint8)
        raised = (-(-impacts // STEP)).astype(np.uint8)
        own_terms, own_tops, summary_sizes = [], [], np.zeros(len(starts), np.int64)
        for b in np.flatnonzero(sizes[block_lists] > SHORT):
            at, _ = ragged(ends, places[starts[b] : stops[b]])
            values, spots = raised[at], terms[at]
            rising = np.argsort(values, kind="stable")
            # The last and so the largest value of a term stays.
            top[spots[rising]] = values[rising]
            found = np.flatnonzero(top)
            own_terms.append(found.astype(np.int32))
            own_tops.append(top[found])
            summary_sizes[b] = len(found)
            top[found] = 0
        joined = np.concatenate(own_terms) if own_terms else np.zeros(0, np.int32)
        tops = np.concatenate(own_tops) if own_tops else np.zeros(0, np.uint8)
        return cls(docs, ends, terms, impacts, lists, list_ends, places, block_lists, starts, stops, np.cumsum(summary_sizes), joined, tops)

    def arrays(self) -> list[np.ndarray]:
        return [
            self.ends, self.terms, self.impacts, self.lists, self.list_ends, self.places, self.block_lists,
            self.block_starts, self.block_ends, self.summary_ends, gaps(self.summary_terms, self.summary_ends), self.summary_tops,
        ]

    def row(self, pick: int) -> pa.RecordBatch:
        columns = [pa.array([pick], pa.int32()), pa.array([self.docs], pa.list_(pa.int64()))]
        columns += [pa.array([packed(a)], pa.binary()) for a in self.arrays()]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SEGMENT.split(", ")])

    @classmethod
    def read(cls, row: dict) -> Segment:
        arrays = [unpacked(row[c.split()[0]]) for c in SEGMENT.split(", ")[2:]]
        # Small numbers are read as they are; places and sizes are counted with.
        whole = [a.astype(np.int64) if a.dtype == np.uint8 else a for a in arrays[:-2]]
        return cls(row["docs"], *whole, from_gaps(arrays[-2], whole[-1]), arrays[-1])

    def scores(self, places: np.ndarray, weight: np.ndarray) -> np.ndarray:
        at, begins = ragged(self.ends, places)
        return np.add.reduceat(weight[self.terms[at]] * self.impacts[at], begins)

    def bounds(self, blocks: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """No document of a block has a higher score; lists without summaries are not bounded."""
        out = np.full(len(blocks), np.iinfo(np.int64).max)
        told = np.flatnonzero(self.sizes[self.block_lists[blocks]] > SHORT)
        if len(told):
            at, begins = ragged(self.summary_ends, blocks[told])
            out[told] = np.add.reduceat(weight[self.summary_terms[at]] * self.summary_tops[at].astype(np.int64), begins) * STEP
        return out

    def members(self, blocks: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Documents of blocks that are not among the seen; they are from now on."""
        sizes = self.block_ends[blocks] - self.block_starts[blocks]
        begins = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.block_starts[blocks] - begins[:-1], sizes) + np.arange(begins[-1])
        found = np.unique(self.places[at])
        found = found[~seen[found]]
        seen[found] = True
        return found

    def best(self, terms: np.ndarray, weight: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of all documents that may be among the k best with a score of `least` or more,
        and how many documents were scored. `weight` holds the item's weights by term, 0 for others."""
        none = np.zeros(0, np.int64)
        at = np.searchsorted(self.lists, terms)
        at = at[(at < len(self.lists))]
        at = at[np.isin(self.lists[at], terms)]
        at = at[weight[self.lists[at]] > 0]
        if not len(at):
            return none, none, 0
        strongest = weight[self.lists[at]] * self.list_tops[at]
        rising = np.argsort(strongest, kind="stable")
        opened = at[rising[np.cumsum(strongest[rising]) >= max(least, 1)]]
        if not len(opened):
            return none, none, 0
        first, after = self.first_block[opened], self.first_block[opened + 1]
        sizes = after - first
        begins = np.concatenate(([0], np.cumsum(sizes)))
        blocks = np.repeat(first - begins[:-1], sizes) + np.arange(begins[-1])
        bounds = self.bounds(blocks, weight)
        falling = np.argsort(-bounds, kind="stable")
        blocks, bounds = blocks[falling], bounds[falling]
        seen = np.zeros(len(self.ends), bool)
        places, scores, begin = [none], [none], 0
        # In rounds of growing size, as the threshold rises fastest in the beginning.
        step = max(1, 2 * k // BLOCK)
        while begin < len(blocks) and bounds[begin] >= least:
            part = blocks[begin : begin + step][bounds[begin : begin + step] >= least]
            found = self.members(part, seen)
            if len(found):
                places.append(found)
                scores.append(self.scores(found, weight))
                so_far = np.concatenate(scores)
                if len(so_far) >= k:
                    least = max(least, int(np.partition(so_far, len(so_far) - k)[len(so_far) - k]))
            begin, step = begin + step, 4 * step
        place, score = np.concatenate(places), np.concatenate(scores)
        good = np.flatnonzero(score >= max(least, 1))
        return place[good], score[good], len(place)

    @property
    def list_tops(self) -> np.ndarray:
        """The largest impact in each list."""
        if not hasattr(self, "_list_tops"):
            order = np.argsort(self.terms, kind="stable")
            starts = self.list_ends - self.sizes
            self._list_tops = np.maximum.reduceat(self.impacts[order], starts).astype(np.int64)
        return self._list_tops


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment of documents that come in order of similarity."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        docs, sizes, terms, impacts, entries = [], [], [], [], 0

        def built() -> pa.RecordBatch:
            ends = np.cumsum(np.concatenate(sizes)).astype(np.int64)
            own = Segment.build(docs, ends, np.concatenate(terms), np.concatenate(impacts).astype(np.int64))
            return own.row(int(mix(np.array([entries + len(docs) * 31 + (docs[0] or 0)]).astype(np.uint64))[0] >> np.uint64(33)))

        for batch in batches:
            ends, own = lists_in(batch.column("terms"))
            values = batch.column("impacts").flatten().to_numpy()
            begin = 0
            while begin < len(ends):
                base = ends[begin - 1] if begin else 0
                # As many documents as fit, at least one.
                room = int(np.searchsorted(ends, base + SEGMENT_ENTRIES - entries, "right"))
                end = max(min(room, begin + SEGMENT_DOCS - len(docs)), begin + (not docs))
                if end > begin:
                    docs += batch.column("doc_id").slice(begin, end - begin).to_pylist()
                    sizes.append(np.diff(ends[begin:end], prepend=base))
                    terms.append(own[base : ends[end - 1]])
                    impacts.append(values[base : ends[end - 1]])
                    entries += int(ends[end - 1] - base)
                    begin = end
                if begin < len(ends):
                    yield built()
                    docs, sizes, terms, impacts, entries = [], [], [], [], 0
        if docs:
            yield built()

    return rows.select("doc_id", "terms", "impacts").mapInArrow(cut, SEGMENT)


def searched(index: DataFrame, wave: Wave, weights: np.ndarray, k: int, least: np.ndarray) -> DataFrame:
    """query, doc_id and score of all documents that may be among an item's k best."""
    shared = index.sparkSession.sparkContext.broadcast((wave.terms, weights, least))

    def search(batches) -> Iterator[pa.RecordBatch]:
        terms, weights, least = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                own = Segment.read(batch.slice(i, 1).to_pylist()[0])
                weight = np.zeros(len(weights), np.int64)
                queries, docs, scores = [], [], []
                for q, known in enumerate(terms):
                    weight[known] = weights[known]
                    places, found, _ = own.best(known, weight, k, int(least[q]))
                    weight[known] = 0
                    queries.append(np.full(len(places), q, np.int32))
                    docs += [own.docs[p] for p in places]
                    scores.append(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(queries)), pa.array(docs, pa.int64()), pa.array(np.concatenate(scores))],
                    names=["query", "doc_id", "score"],
                )

    rows = index.mapInArrow(search, "query int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def indexed(spark: SparkSession, docs: DataFrame, wave: Wave) -> tuple[DataFrame, np.ndarray]:
    """The stored segments of all documents for the terms of a wave, and the terms' weights."""
    rows = stored(spark, vectors(docs, wave.vocabulary), "lexical-vectors")
    counted = rows.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    frequencies = document_frequencies(rows, len(wave.vocabulary))
    weights = term_weights(frequencies, counted["documents"])
    near = in_order_of_similarity(rows, counted["documents"], max(1, counted["total"]), weights)
    return stored(spark, segments(near), "lexical-segments"), weights


def thresholds(index: DataFrame, wave: Wave, weights: np.ndarray, k: int) -> np.ndarray:
    """For each item the k-th best score in a few segments: the k best of all are not below it."""
    share = SEEDS / max(1, index.count())
    some = index if share >= 1 else index.filter(F.col("pick") < int(share * (1 << 31)))
    none = np.zeros(len(wave.items), np.int64)
    out = none.copy()
    if share < 1:
        for r in searched(some, wave, weights, k, none).filter(F.col("rank") == k).collect():
            out[r["query"]] = r["score"]
    return out


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents with a score above 0 for each item.

    Reads `doc_id` and `text` of documents, `item_id` and `text` of items.
    """
    importable(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for wave in waves(items):
        index, weights = indexed(spark, docs, wave)
        rows = searched(index, wave, weights, k, thresholds(index, wave, weights, k))
        names = spark.createDataFrame(list(enumerate(wave.items)), f"query int, item_id {kind}")
        out = out.unionAll(rows.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return out
