"""Rule statistics of texts, and an isolation forest over them.

The statistics of a text are counted over all of it, once. Each tree of the forest draws `subsample` rows from
all documents that pass the base rules (those with its smallest hashes of id, text and tree) and
splits them at random places of random statistics until they are alone; the path length to a
row, averaged over trees, says how easily it is set apart. All labelled rows give the threshold:
the score above which at most `lost_good` of the rows labelled good lie.

A null text has no words: its counts are 0, and with fewer than `least_words` words it fails
the base rules. Repeated rows and ids are scored each on their own. Without labelled rows no
document is rejected by the forest; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.storage import importable, stored, utf8
from tributary.llm.text import SPACE, batches_of_texts, prefix_hash, shingle_hashes, span_hashes, word_spans

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[0x41:0x5B] = True
LETTER = UPPER.copy()
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True
MARK = np.zeros(256, dtype=bool)
MARK[0x21:0x7F] = True
MARK &= ~LETTER
MARK[0x30:0x3A] = False

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Repetition is left to the base rules: quoted passages repeat words in good texts as well.
FEATURES = ("word_length", "symbols", "capitals", "marks", "distinct_words")


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def repeated_words(words: np.ndarray) -> tuple[int, int]:
    """Words in three-word windows that the text has twice or more; and distinct words."""
    distinct = len(np.unique(words))
    if len(words) < 4:
        return 0, distinct
    windows = shingle_hashes(words, 3)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(counts) == len(windows):
        return 0, distinct
    twice = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[twice + i] = True
    return int(covered.sum()), distinct


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS (integers) and FEATURES of each text."""
    counts = np.zeros((len(texts), len(COUNTS)), np.int64)
    features = np.zeros((len(texts), len(FEATURES)))
    for begin, end in batches_of_texts(texts):
        part = texts[begin:end]
        joined = np.frombuffer(b"\n".join(part), np.uint8)
        sums = prefix_hash(joined)
        starts, ends = word_spans(joined)
        words = span_hashes(sums, starts, ends)
        offsets = np.concatenate(([0], np.cumsum(np.fromiter((len(t) + 1 for t in part), np.int64, len(part)))))
        cut = np.searchsorted(starts, offsets)

        def total(flags: np.ndarray) -> np.ndarray:
            running = np.concatenate(([0], np.cumsum(flags)))
            at = np.minimum(offsets, len(flags))
            return running[at[1:]] - running[at[:-1]]

        chars = total(~SPACE[joined] & ((joined & 0xC0) != 0x80))
        symbols, capitals = total(SYMBOLS[joined]), total(UPPER[joined])
        letters, marks = total(LETTER[joined] & ((joined & 0xC0) != 0x80)), total(MARK[joined])
        for i, text in enumerate(part):
            own = words[cut[i] : cut[i + 1]]
            repeats, distinct = repeated_words(own)
            n = len(own)
            counts[begin + i] = n, chars[i], symbols[i], repeated_lines(text), repeats
            features[begin + i] = (
                chars[i] / max(1, n), symbols[i] / max(1, chars[i]),
                capitals[i] / max(1, letters[i]), marks[i] / max(1, n), distinct / max(1.0, n) * np.log10(n + 10),
            )
    return counts, features


def usual_path(rows: np.ndarray | float) -> np.ndarray:
    """Mean path length in a random tree over so many rows."""
    rows = np.asarray(rows, float)
    harmonic = np.log(np.maximum(rows - 1, 1)) + 0.5772156649015329
    return np.where(rows > 2, 2 * harmonic - 2 * (rows - 1) / np.maximum(rows, 1), np.where(rows == 2, 1.0, 0.0))


class Forest:
    """Isolation trees as arrays: a leaf points to itself and holds its path length."""

    def __init__(self, rows: np.ndarray, trees: int, subsample: int, seed: int) -> None:
        random = np.random.default_rng(seed)
        size = min(subsample, len(rows))
        self._plant([rows[random.choice(len(rows), size, replace=False)] for _ in range(trees)], random)

    @classmethod
    def over(cls, samples: list[np.ndarray], seed: int) -> Forest:
        """A tree over each of the samples."""
        forest = cls.__new__(cls)
        forest._plant(samples, np.random.default_rng(seed))
        return forest

    def _plant(self, samples: list[np.ndarray], random: np.random.Generator) -> None:
        self.subsample = max(len(s) for s in samples)
        self.depth = max(1, int(np.ceil(np.log2(max(2, self.subsample)))))
        self.trees = []
        for chosen in samples:
            feature, split, left, right, path = [], [], [], [], []

            def grow(own: np.ndarray, depth: int) -> int:
                node = len(feature)
                for column, value in ((feature, 0), (split, 0.0), (left, node), (right, node), (path, depth)):
                    column.append(value)
                low, high = own.min(axis=0), own.max(axis=0)
                varied = np.flatnonzero(high > low)
                if depth >= self.depth or len(own) <= 1 or not len(varied):
                    path[node] = depth + float(usual_path(len(own)))
                    return node
                f = int(random.choice(varied))
                at = random.uniform(low[f], high[f])
                below = own[:, f] <= at
                feature[node], split[node] = f, at
                left[node], right[node] = grow(own[below], depth + 1), grow(own[~below], depth + 1)
                return node

            grow(chosen, 0)
            self.trees.append(tuple(np.array(c) for c in (feature, split, left, right, path)))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1: set apart after few splits; 0.5 and less: among many."""
        if not len(rows):
            return np.zeros(0)
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, split, left, right, path in self.trees:
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                node = np.where(rows[every, feature[node]] <= split[node], left[node], right[node])
            total += path[node]
        return 2.0 ** (-total / len(self.trees) / max(1e-9, float(usual_path(self.subsample))))


def base_failed(counts: np.ndarray, least_words: int, most_repeated: int) -> np.ndarray:
    """Too few words, or more than `most_repeated` percent of them repeated."""
    words, repeats = counts[:, 0], counts[:, 4]
    return (words < least_words) | (100 * repeats > most_repeated * words)


def measured(docs: DataFrame, least_words: int, most_repeated: int) -> DataFrame:
    """doc_id, draw (hash of id and text), COUNTS, base_failed and features of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def measure(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = statistics(utf8(batch.column("text")))
            failed = base_failed(counts, least_words, most_repeated)
            found = pa.array(list(features), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("draw"), *(pa.array(c) for c in counts.T), pa.array(failed), found],
                names=["doc_id", "draw", *COUNTS, "base_failed", "features"],
            )

    counted = ", ".join(f"{c} long" for c in COUNTS)
    drawable = rows.withColumn("draw", F.xxhash64("doc_id", "text"))
    return drawable.mapInArrow(measure, f"doc_id long, draw long, {counted}, base_failed boolean, features array<double>")


def features_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Hashes of 64-bit numbers."""
    x = numbers + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(rows: DataFrame, trees: int, subsample: int, seed: int) -> list[np.ndarray]:
    """For every tree the features of the `subsample` rows with the smallest hashes of tree and `draw`; all if there are fewer.

    A task sends at most so many rows for a tree; the driver sees the chosen ones.
    """
    salts = mixed(np.arange(trees, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32))[:, None]

    def draw(batches) -> Iterator[pa.RecordBatch]:
        keys, found = np.zeros((trees, 0), np.int64), np.zeros((trees, 0, len(FEATURES)))
        for batch in batches:
            own = mixed(batch.column("draw").to_numpy(zero_copy_only=False).view(np.uint64)[None, :] ^ salts)
            keys = np.concatenate([keys, (own >> np.uint64(1)).astype(np.int64)], axis=1)
            features = features_of(batch)
            found = np.concatenate([found, np.broadcast_to(features, (trees, *features.shape))], axis=1)
            if keys.shape[1] > subsample:
                least = np.argpartition(keys, subsample - 1, axis=1)[:, :subsample]
                keys, found = np.take_along_axis(keys, least, 1), np.take_along_axis(found, least[:, :, None], 1)
        if keys.size:
            tree = np.repeat(np.arange(trees, dtype=np.int32), keys.shape[1])
            listed = pa.array(list(found.reshape(-1, len(FEATURES))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(keys.ravel()), listed], names=["tree", "key", "features"])

    candidates = rows.mapInArrow(draw, "tree int, key long, features array<double>")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("key", "features"))
    chosen = candidates.withColumn("rank", rank).filter(F.col("rank") <= subsample)
    samples: list[list] = [[] for _ in range(trees)]
    for r in sorted(chosen.collect(), key=lambda r: (r["tree"], r["rank"])):
        samples[r["tree"]].append(r["features"])
    return [np.array(s) for s in samples if s]


def nth_smallest(values: DataFrame, column: str, rank: int, bands: int = 4096) -> float:
    """The value of a rank (from 0) among all rows.

    The range of values is cut into bands, of which the driver sees the counts; the band that holds the rank is cut
    again until its values are equal.
    """
    value = F.col(column)
    low, high = values.agg(F.min(value), F.max(value)).first()
    while low < high:
        band = F.least(F.floor((value - F.lit(low)) / F.lit((high - low) / bands)), F.lit(bands - 1))
        inside = values.filter((value >= F.lit(low)) & (value <= F.lit(high)))
        counts = inside.groupBy(band.alias("band")).agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        for r in sorted(counts.collect(), key=lambda r: r["band"]):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return low


def threshold_of(spark: SparkSession, scores: DataFrame, labels: DataFrame, lost_good: float) -> float:
    """The score above which at most `lost_good` of all rows labelled good lie; 1 without any."""
    known = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
    )
    good = stored(spark, scores.filter("NOT base_failed").join(known.filter("quality = 1"), "doc_id").select("anomaly"), "good-scores")
    count = good.count()
    return nth_smallest(good, "anomaly", min(count - 1, int(np.ceil((1 - lost_good) * count)))) if count else 1.0


def judged(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    least_words: int = 50,
    most_repeated: int = 50,
    trees: int = 100,
    subsample: int = 256,
    lost_good: float = 0.002,
    seed: int = 1,
) -> DataFrame:
    """doc_id, COUNTS, base_failed, anomaly (score of the forest), threshold, kept."""
    rows = stored(importable(spark), measured(docs, least_words, most_repeated), "rule-statistics")
    samples = drawn(rows.filter("NOT base_failed").select("draw", "features"), trees, subsample, seed)
    model = spark.sparkContext.broadcast(Forest.over(samples, seed) if samples else None)
    others = ["doc_id", *COUNTS, "base_failed"]

    def score(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forest = model.value
            scores = forest.score(features_of(batch)) if forest else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(scores)], names=[*others, "anomaly"])

    counted = ", ".join(f"{c} long" for c in COUNTS)
    scored = rows.mapInArrow(score, f"doc_id long, {counted}, base_failed boolean, anomaly double")
    scored = stored(spark, scored, "rule-scores")
    threshold = threshold_of(spark, scored, labels, lost_good)
    kept = ~F.col("base_failed") & (F.col("anomaly") <= F.lit(threshold))
    return scored.select(*others, "anomaly", F.lit(threshold).alias("threshold"), kept.alias("kept"))
