"""Quality classifier: naive Bayes support vectors over n-grams.

A text is the set of its byte n-grams and of the patterns of its word trigrams (which of the three
words are equal), hashed into `1 << BITS` places. Each place is scaled by
its log-count ratio between the classes of the labelled rows, and a linear model with hinge
loss is fitted on the scaled indicators by dual coordinate descent. A logistic curve through margins of
rows held back turns a margin into a score. The model is fitted on a bounded sample
of labelled rows (`sample_rows` per class, those with the smallest hash of their id).

Learned from: text and label of rows whose crc32(doc_id as text) mod 3 is not 1. A null text is
empty: it has no n-grams and its score is that of the bias. A null doc_id is neither learned from nor
held out. Repeated rows are scored each; a repeated label counts once (the smaller one). With
no labelled row of one class every score is 0.5; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.storage import importable, spread, thinned, utf8
from tributary.llm.text import BASE, hashed_words, mix

BITS = 17
ORDERS = (1, 2, 3, 4)


def held_out() -> F.Column:
    """Rows that are only scored."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


class Indicators:
    """The distinct hashed n-grams of texts, without sorting: the last writer of a place counts."""

    def __init__(self) -> None:
        self.last = np.zeros(1 << BITS, np.int64)

    def of_all(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for i, words in hashed_words(texts, fold_case=False):
            yield self.of(texts[i], words)

    def of(self, text: bytes, words: np.ndarray) -> np.ndarray:
        data = np.frombuffer(text, np.uint8).astype(np.uint64)
        found, value = [], np.zeros(len(data), np.uint64)
        for order in range(1, max(ORDERS) + 1):
            if len(data) < order:
                break
            value = value[: len(data) - order + 1] * np.uint64(BASE) + data[order - 1 :] + np.uint64(1)
            if order in ORDERS:
                found.append((mix(value + np.uint64(order)) >> np.uint64(64 - BITS)).astype(np.int64))
        if not found:
            return np.zeros(0, np.int64)
        if len(words) > 2:
            a, b, c = words[:-2], words[1:-1], words[2:]
            pattern = (a == b) + 2 * (b == c).astype(np.int64) + 4 * (a == c)
            found.append(np.flatnonzero(np.bincount(pattern, minlength=8)))
        places = np.concatenate(found)
        order = np.arange(len(places))
        self.last[places] = order
        return places[self.last[places] == order]


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Per place the log of how much more often good texts have it, counts over each class in proportion."""
    ratios = []
    for wanted in (True, False):
        counts = np.full(1 << BITS, smoothing)
        for row, is_good in zip(rows, good):
            if is_good == wanted:
                counts[row] += 1
        ratios.append(np.log(counts / counts.sum()))
    return ratios[0] - ratios[1]


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, good: np.ndarray, cost: float, rounds: int, seed: int):
    """Weights (already times `scale`) and bias of the linear model with hinge loss.

    Rows are scaled to unit length, so texts of all lengths weigh alike.
    """
    random = np.random.default_rng(seed)
    values = [(scale[r] / max(1e-9, float(np.linalg.norm(scale[r])))).astype(np.float32) for r in rows]
    weights, bias = np.zeros(1 << BITS), 0.0
    alpha, sign = np.zeros(len(rows)), np.where(good, 1.0, -1.0)
    # The classes count alike, however many rows they have.
    upper = np.where(good, cost * len(rows) / (2 * good.sum()), cost * len(rows) / (2 * (~good).sum()))
    for _ in range(rounds):
        largest = 0.0
        for i in random.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            before = alpha[i]
            # A unit row and the constant: the diagonal is 2.
            alpha[i] = min(max(before - gradient / 2.0, 0.0), upper[i])
            step = (alpha[i] - before) * sign[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weights, bias


def margin(row: np.ndarray, weights: np.ndarray, bias: float, scale: np.ndarray) -> float:
    if not len(row):
        return bias
    own = scale[row]
    return float(weights[row] @ own / max(1e-9, np.linalg.norm(own)) + bias)


def logistic(margins: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve through weighted margins, by Newton steps with a small ridge."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        error, curve = weight * (p - good), weight * p * (1 - p)
        gradient = np.array([error @ margins + 1e-3 * slope, error.sum() + 1e-3 * offset])
        hessian = np.array([[curve @ (margins**2) + 1e-3, curve @ margins], [curve @ margins, curve.sum() + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(slope, 1e-3), offset


class Model:
    """Weights, bias, scale and the curve."""

    def __init__(self, rows: list[np.ndarray], good: np.ndarray, shares: tuple[float, float], cost: float, rounds: int, seed: int):
        self.known = bool(good.any() and (~good).any())
        if not self.known:
            return
        back = np.arange(len(rows)) % 5 == 0
        fit = np.flatnonzero(~back)
        if not (good[fit].any() and (~good[fit]).any()):
            fit, back = np.arange(len(rows)), np.ones(len(rows), bool)
        own = [rows[i] for i in fit]
        self.scale = log_count_ratios(own, good[fit])
        self.weights, self.bias = dual_coordinate_descent(own, self.scale, good[fit], cost, rounds, seed)
        aside = np.flatnonzero(back)
        margins = np.array([margin(rows[i], self.weights, self.bias, self.scale) for i in aside])
        # The sample takes as many rows of either class; the curve counts them by their shares.
        of_class = np.where(good[aside], shares[0] / max(1, good[aside].sum()), shares[1] / max(1, (~good[aside]).sum()))
        self.slope, self.offset = logistic(margins, good[aside].astype(float), of_class * len(aside))

    def score(self, row: np.ndarray) -> float:
        if not self.known:
            return 0.5
        at = self.slope * margin(row, self.weights, self.bias, self.scale) + self.offset
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int, cost: float, rounds: int, seed: int) -> Model:
    """The model of a bounded sample: `sample_rows` labelled documents of each class."""
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .filter(~held_out())
    )
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    order = spread(["doc_id"])
    classes = [known.filter(F.col("quality") == q) for q in (0, 1)]
    parts = [thinned(c, ["doc_id"], sample_rows).orderBy(*order).limit(sample_rows) for c in classes]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def featured(batches) -> Iterator[pa.RecordBatch]:
        find = Indicators()
        for batch in batches:
            places = [p.astype(np.int32) for p in find.of_all(utf8(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(places, pa.list_(pa.int32()))],
                names=["doc_id", "quality", "places"],
            )

    # At most 2 * sample_rows ids go to every task; the texts are not shuffled.
    chosen = rows.join(F.broadcast(parts[0].unionAll(parts[1])), "doc_id").select("doc_id", F.col("quality").cast("int"), "text")
    sample = chosen.mapInArrow(featured, "doc_id long, quality int, places array<int>")
    found = sample.orderBy(*order, F.xxhash64("places")).limit(2 * sample_rows).select("quality", "places").toArrow().combine_chunks()
    total = max(1, sum(shares.values()))
    good = found.column("quality").to_numpy() == 1
    # Views of one array of four bytes per indicator.
    chunk = found.column("places").chunk(0) if len(good) else pa.array([], pa.list_(pa.int32()))
    flat, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
    places = [flat[a:b] for a, b in zip(ends, ends[1:])]
    return Model(places, good, (shares.get(1, 0) / total, shares.get(0, 0) / total), cost, rounds, seed)


def scored(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 2000,
    cost: float = 1.0,
    rounds: int = 30,
    seed: int = 1,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better), predicted."""
    importable(spark)
    model = spark.sparkContext.broadcast(train(docs, labels, sample_rows, cost, rounds, seed))

    def score(batches) -> Iterator[pa.RecordBatch]:
        find = Indicators()
        for batch in batches:
            own = np.array([model.value.score(p) for p in find.of_all(utf8(batch.column(2)))], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own), pa.array((own >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
