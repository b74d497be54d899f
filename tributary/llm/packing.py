"""Best-fit packing of token sequences by minimum bin slack.

Documents become pieces of at most `capacity` tokens; only longer documents are cut. Which
lengths share a sequence depends on the number of pieces per length alone, at most
`capacity` numbers whatever the size of the corpus: this histogram is planned as a whole.
For each bin the largest length that is left is fixed, and a bitset subset-sum over the
available lengths finds the fullest feasible combination; it is removed as often as the
counts allow. A length then has fewer pieces left than the combination took of it, so the
plan has at most sum(capacity / length), about capacity * ln(capacity), combinations. Pieces are numbered within their length by running counts
per task, and each looks up its combination by its number.

A null text counts as empty: it has no ids but the closing one. Repeated rows and ids are packed
like any others. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.bpe import KEEPER, WORDS_KEPT, encoder, slices
from tributary.llm.storage import importable, stored, tidy, utf8

PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

# Length and how often it occurs, for one combination; and how many bins take it.
Combination = tuple[list[tuple[int, int]], int]


def fullest(available: list[tuple[int, int]], space: int) -> list[tuple[int, int]]:
    """The multiset of available lengths (length, count) with the largest sum up to `space`.

    `reach[i]` has bit s set if the lengths before i can sum to s; counts are taken in
    powers of two, so a length costs few shifts. Stops as soon as the space can be filled.
    """
    mask = (1 << (space + 1)) - 1
    reach = [1]
    steps: list[tuple[int, int]] = []
    for length, count in available:
        if length > space:
            continue
        count, batch = min(count, space // length), 1
        while count > 0:
            batch = min(batch, count)
            steps.append((length, batch))
            reach.append((reach[-1] | reach[-1] << (length * batch)) & mask)
            count -= batch
            batch *= 2
        if reach[-1] >> space & 1:
            break
    total = reach[-1].bit_length() - 1
    chosen: dict[int, int] = {}
    for (length, batch), before in zip(reversed(steps), reversed(reach[:-1])):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + batch
            total -= length * batch
    return list(chosen.items())


def plan(histogram: dict[int, int], capacity: int) -> list[Combination]:
    """Combinations for all pieces: per combination the lengths in it and its number of bins."""
    left = {length: count for length, count in histogram.items() if count > 0}
    lengths = sorted(left)
    combinations: list[Combination] = []
    while lengths:
        seed = lengths[-1]
        available = [(n, left[n] - (n == seed)) for n in reversed(lengths) if left[n] > (n == seed)]
        chosen = dict(fullest(available, capacity - seed))
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del lengths[bisect.bisect_left(lengths, n)]
        combinations.append((sorted(chosen.items(), reverse=True), times))
    return combinations


def pieces(
    spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int, closing_id: int, words_kept: int = WORDS_KEPT
) -> DataFrame:
    """Stored pieces of all documents, numbered per task and length."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids_crc32", pa.int64()), ("task", pa.string()), ("place", pa.int64())]
    )
    closing = np.array([closing_id], "<u4").tobytes()

    def cut(batches) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, words_kept)
        # Names the attempt; rows of attempts that fail are never committed.
        task = uuid.uuid4().hex
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            numbers, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            for begin, end in slices(texts):
                rows = []
                for number, ids in zip(numbers[begin:end], own.encode(texts[begin:end])):
                    ids += closing
                    count = len(ids) // 4
                    for piece, start in enumerate(range(0, count, capacity)):
                        length = min(capacity, count - start)
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((number, piece, start, length, crc, task, int(seen[length])))
                        seen[length] += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    importable(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    made = rows.mapInArrow(tidy(cut, KEEPER), "doc_id long, piece int, start long, length long, ids_crc32 long, task string, place long")
    return stored(spark, made, "pieces")


def packed(
    spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 4096, closing_id: int = 1, words_kept: int = WORDS_KEPT
) -> DataFrame:
    """Every piece with the sequence it is in and its place there (columns of PACKED).

    `words_kept` bounds a worker's cache: more words take more memory and less time.
    """
    rows = pieces(spark, docs, tokenizer, capacity, closing_id, words_kept)
    per_task = rows.groupBy("length", "task").agg(F.max("place").alias("last"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select("length", "task", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("before"), "last")
    # At most `capacity` rows.
    found = per_task.groupBy("length").agg(F.sum(F.col("last") + 1).alias("pieces")).collect()
    combinations = plan({r["length"]: r["pieces"] for r in found}, capacity)

    # Per length the runs of numbers that go to a combination: where they begin, how many of
    # the length are in one bin, the combination's first bin and the place of the first one.
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first_bin = 0
    for chosen, times in combinations:
        place = 0
        for length, each in chosen:
            runs.setdefault(length, []).append((taken.get(length, 0), each, first_bin, place))
            taken[length] = taken.get(length, 0) + each * times
            place += each * length
        first_bin += times
    tables = {length: np.array(r, np.int64) for length, r in runs.items()}
    shared = importable(spark).sparkContext.broadcast(tables)

    def assign(batches) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            number = batch.column("number").to_numpy(zero_copy_only=False)
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros_like(number), np.zeros_like(number)
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.diff(lengths[order])) + 1
            for at in np.split(order, edges):
                if not len(at):
                    continue
                length = int(lengths[at[0]])
                table = own[length]
                run = table[np.searchsorted(table[:, 0], number[at], side="right") - 1]
                within = number[at] - run[:, 0]
                sequence[at] = run[:, 2] + within // run[:, 1]
                offset[at] = run[:, 3] + within % run[:, 1] * length
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = rows.join(per_task.drop("last"), ["length", "task"]).withColumn("number", F.col("before") + F.col("place"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(tidy(assign, KEEPER), PACKED)
