"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posterior labels.

Voters look at a text's units, its distinct terms and their beginnings of four and six bytes (ASCII letters folded):
* fixed lexicons of abusive words, and patterns (insults in the second person, masked words, shouting);
* lexicons mined from the labelled rows that may be learned from: units that toxic texts have more often than
  others, by the lower end of their log odds ratio, counted over all those rows;
* the labels themselves, one voter that is absent elsewhere.
A voter is silent, fires, or fires on two units or more. The label model is a latent class model in which a
voter depends on the class and on at most one other voter: a tree of the strongest correlations given the
class. Its accuracies and correlations are estimated by expectation maximisation over the counts of all vote patterns
of all documents. A logistic regression on votes and the strongest units is fitted to the posterior labels
of a bounded sample of labelled rows (`sample_rows` per label) and scores every text; labels are not seen there.

Learned from: labels of rows whose crc32(doc_id as text) mod 5 is not 0. A null text is empty: no voter fires.
A null doc_id is neither learned from nor held out. Rows with one doc_id are scored each; of repeated labels toxic
counts. Without labels of either kind the score is the label model's posterior. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.storage import importable, spread, stored, summed, thinned, utf8
from tributary.llm.text import LOWER, NO_TERM, batches_of_texts, mix, prefix_hash, span_hashes, word_spans

# Abusive words, a voter for each line.
LEXICONS = {
    "insults": "idiot idiots moron morons stupid dumb dumbass imbecile loser losers clown clowns fool fools jerk freak creep retard",
    "contempt": "pathetic worthless disgusting scum trash garbage filth filthy vermin subhuman useless lowlife degenerate repulsive",
    "profanity": "fuck fucking fucker shit shitty bullshit bitch bitches bastard asshole crap damn cunt whore slut dick piss",
    "threats": "kill murder die hang shoot stab beat burn destroy exterminate rape lynch",
    "german": "idioten dummkopf arschloch scheiße scheiss hurensohn wichser fotze schlampe abschaum drecksau vollidiot missgeburt",
    "french": "connard connards connasse salaud salope imbécile crétin abruti merde putain enculé ordure débile",
    "spanish": "idiota idiotas estúpido estúpida imbécil cabrón puta puto mierda gilipollas pendejo basura maricón asqueroso",
}
PATTERNS = {
    "second_person": re.compile(rb"\b(?:you|u|ur|you're|your) (?:are |r )?(?:a |an |such |so |all |just |nothing |fucking )"),
    "masked": re.compile(rb"\b[a-z]{1,3}[*@]{1,4}[a-z]{1,4}\b"),
}
SHOUTING = 0.6  # share of capitals among ASCII letters

PREFIXES = (4, 6)
MINED_VOTERS = 8  # for terms, and as many for beginnings
NAMES = [*LEXICONS, *PATTERNS, "shouting", *[f"terms_{i}" for i in range(MINED_VOTERS)], *[f"beginnings_{i}" for i in range(MINED_VOTERS)]]
VOTERS = len(NAMES)
FIRST_MINED = len(LEXICONS) + len(PATTERNS) + 1
STATES = 3
BLOOM_WORDS = 1 << 17


def held_out() -> F.Column:
    """Rows that are only scored."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def units_of(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, int]]:
    """(index of the text, its distinct units, its number of terms). The lowest bit tells terms (0) from beginnings (1)."""
    for begin, end in batches_of_texts(texts):
        joined = LOWER[np.frombuffer(b"\n".join(texts[begin:end]), dtype=np.uint8)]
        sums = prefix_hash(joined)
        starts, ends = word_spans(joined, NO_TERM)
        hashes = span_hashes(sums, starts, ends)
        offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts[begin:end]])))
        cut = np.searchsorted(starts, offsets)
        for i in range(end - begin):
            own, first = np.unique(hashes[cut[i] : cut[i + 1]], return_index=True)
            first += cut[i]
            found = [own << np.uint64(1)]
            for size in PREFIXES:
                at = starts[first[ends[first] - starts[first] > size]]
                found.append(span_hashes(sums, at, at + size) << np.uint64(1) | np.uint64(1))
            yield begin + i, np.unique(np.concatenate(found)), int(cut[i + 1] - cut[i])


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1) of the labelled rows that may be learned from."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return rows.agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out())


def likely_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id may be among `ids`, so that few others are shuffled: a filter of `BLOOM_WORDS` words of 64 bits."""
    place, bit = f"pmod(shiftright(xxhash64(doc_id), 6), {BLOOM_WORDS})", "shiftleft(1L, int(xxhash64(doc_id) & 63L))"
    words = ids.groupBy(F.expr(place).alias("_place")).agg(F.expr(f"bit_or({bit})").alias("_bits"))
    # At most BLOOM_WORDS rows of two numbers.
    return rows.withColumn("_place", F.expr(place)).join(F.broadcast(words), "_place").filter(F.expr(f"_bits & {bit} <> 0")).drop("_place", "_bits")


def unit_counts(rows: DataFrame) -> DataFrame:
    """For each unit how many toxic and other texts have it. `rows`: text, toxic."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]
        size = 0

        def counted() -> pa.RecordBatch:
            both = [np.unique(np.concatenate(h) if h else np.zeros(0, np.uint64), return_counts=True) for h in held]
            found = np.union1d(both[0][0], both[1][0])
            counts = np.zeros((2, len(found)), np.int64)
            for row, (own, n) in zip(counts, both):
                row[np.searchsorted(found, own)] = n
            return pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(counts[1]), pa.array(counts[0])], names=["unit", "toxic", "clean"]
            )

        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            for i, found, _ in units_of(utf8(batch.column("text"))):
                held[toxic[i]].append(found)
                size += len(found)
                if size > 4_000_000:
                    yield counted()
                    held, size = [[], []], 0
        yield counted()

    parts = rows.select("text", "toxic").mapInArrow(count, "unit long, toxic long, clean long")
    return parts.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def mined(docs: DataFrame, known: DataFrame, size: int) -> np.ndarray:
    """The `size` units most typical of toxic texts, strongest first."""
    classes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        return np.zeros(0, np.uint64)
    # Labels grow with the documents, so both sides are shuffled at every size.
    rows = likely_in(docs.filter("doc_id IS NOT NULL AND text IS NOT NULL"), known).join(known.hint("merge"), "doc_id")
    toxic, clean = F.col("toxic"), F.col("clean")

    def log_odds(count: F.Column, total: int) -> F.Column:
        return F.log((count + 0.5) / (F.greatest(F.lit(total) - count, F.lit(0)) + 0.5))

    # Two standard errors below the log odds ratio.
    least = log_odds(toxic, classes[1]) - log_odds(clean, classes[0]) - 2 * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    strong = unit_counts(rows).filter("toxic >= 3").withColumn("least", least).filter("least > 1")
    found = strong.orderBy(F.desc("least"), "unit").limit(size).select("unit").collect()
    return np.array([r["unit"] for r in found], np.int64).view(np.uint64)


class Voters:
    """The lexicons as sorted units, with the voters each unit belongs to."""

    def __init__(self, units: np.ndarray, strong: int) -> None:
        pairs = []
        for voter, words in enumerate(LEXICONS.values()):
            texts = [w.encode() for w in words.split()]
            for i, found, _ in units_of(texts):
                pairs += [(int(u), voter) for u in found if not u & np.uint64(1)]
        for kind in (0, 1):
            own = units[(units & np.uint64(1)) == kind]
            pairs += [(int(u), FIRST_MINED + kind * MINED_VOTERS + i % MINED_VOTERS) for i, u in enumerate(own)]
        pairs.sort()
        self.units = np.array([u for u, _ in pairs], np.uint64)
        self.voters = np.array([v for _, v in pairs], np.int64)
        # The strongest units are features of the classifier, by their place among these.
        self.strong = np.sort(units[:strong])

    def votes(self, texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, int]]:
        """(index of the text, states of all voters two bits each, strong units, number of terms)."""
        for i, found, terms in units_of(texts):
            # A unit may belong to a fixed and a mined lexicon.
            left, right = np.searchsorted(self.units, found), np.searchsorted(self.units, found, "right")
            hit = np.flatnonzero(right > left)
            hits = np.bincount(self.voters[np.concatenate([np.arange(left[h], right[h]) for h in hit])], minlength=VOTERS) if len(hit) else np.zeros(VOTERS, np.int64)
            text = texts[i]
            lowered = text.lower()
            for j, pattern in enumerate(PATTERNS.values()):
                hits[len(LEXICONS) + j] = sum(1 for _, _ in zip(range(2), pattern.finditer(lowered)))
            letters = np.frombuffer(text, np.uint8)
            capitals = int(((letters >= 0x41) & (letters <= 0x5A)).sum())
            small = int(((letters >= 0x61) & (letters <= 0x7A)).sum())
            hits[FIRST_MINED - 1] = capitals + small >= 20 and capitals > SHOUTING * (capitals + small)
            states = np.minimum(hits, STATES - 1)
            key = int((states << (2 * np.arange(VOTERS))).sum())
            place = np.searchsorted(self.strong, found)
            place = place[place < len(self.strong)] if not len(found) else np.minimum(place, max(0, len(self.strong) - 1))
            strong = place[self.strong[place] == found] if len(self.strong) else np.zeros(0, np.int64)
            yield i, key, strong, terms


def voted(docs: DataFrame, voters: Voters) -> DataFrame:
    """doc_id, votes (two bits per voter), strong (units by number) and terms of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def vote(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shared.value.votes(utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[3] for f in found], pa.int64()),
                ],
                names=["doc_id", "votes", "strong", "terms"],
            )

    return docs.mapInArrow(vote, "doc_id long, votes long, strong array<int>, terms long")


def states_of(votes: np.ndarray) -> np.ndarray:
    """States of the voters: a row per pattern."""
    return (votes[:, None] >> (2 * np.arange(VOTERS))) & 3


class LabelModel:
    """P(class), P(state | class, state of the parent) of each voter and P(label | class).

    `tables[j][y, p, s]`: voter j's state s given class y and its parent's state p (the same for all p without a parent).
    """

    def __init__(self) -> None:
        self.prior = np.array([0.9, 0.1])
        self.parent = np.full(VOTERS, -1)
        self.tables = None
        self.label = np.array([[0.9, 0.1], [0.1, 0.9]])

    def toxic(self, states: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Posterior of the toxic class; label -1 is absent."""
        if self.tables is None:
            fired = (states > 0).sum(axis=1) + (states > 1).sum(axis=1)
            guess = np.select([fired == 0, fired == 1], [0.02, 0.3], 0.8)
            return np.where(label < 0, guess, np.where(label == 1, 0.9, 0.1))
        logs = np.tile(np.log(self.prior), (len(states), 1))
        for j in range(VOTERS):
            above = states[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(states), np.int64)
            logs += np.log(self.tables[j][:, above, states[:, j]]).T
        known = label >= 0
        logs[known] += np.log(self.label[:, label[known]]).T
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))

    def expected(self, patterns: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Expected counts over all documents: [class, voter and state, voter and state], and [class, label]."""
        wide = VOTERS * STATES
        model = self

        def part(batch: pa.RecordBatch) -> np.ndarray:
            states = states_of(batch.column("votes").to_numpy())
            label, count = batch.column("label").to_numpy(), batch.column("count").to_numpy()
            toxic = model.toxic(states, label)
            shown = np.zeros((len(states), wide))
            np.put_along_axis(shown, states + STATES * np.arange(VOTERS), 1.0, axis=1)
            out, labels = np.zeros((2, wide, wide)), np.zeros((2, 2))
            for y, share in enumerate((1 - toxic, toxic)):
                out[y] = (shown * (count * share)[:, None]).T @ shown
                for a in (0, 1):
                    labels[y, a] = (count * share)[label == a].sum()
            return np.concatenate((out.ravel(), labels.ravel()))

        found = summed(patterns, 2 * wide * wide + 4, part)
        return found[:-4].reshape(2, wide, wide), found[-4:].reshape(2, 2)

    def update(self, pairs: np.ndarray, labels: np.ndarray) -> None:
        """Maximisation: relative frequencies, smoothed; labels are taken to be right nine times in ten to begin with."""
        total = np.array([pairs[y, :STATES, :STATES].sum() for y in (0, 1)])
        self.prior = (total + 1) / (total + 1).sum()
        weight = max(10.0, 0.01 * labels.sum())
        counts = labels + weight * np.array([[0.9, 0.1], [0.1, 0.9]])
        self.label = counts / counts.sum(axis=1, keepdims=True)
        self.tables = []
        for j in range(VOTERS):
            own = slice(STATES * j, STATES * (j + 1))
            alone = np.array([np.diag(pairs[y, own, own]) for y in (0, 1)]) + 0.1
            alone /= alone.sum(axis=1, keepdims=True)
            if self.parent[j] < 0:
                table = np.repeat(alone[:, None, :], STATES, axis=1)
            else:
                above = slice(STATES * self.parent[j], STATES * (self.parent[j] + 1))
                # Rare states of the parent lean on the voter's own rates.
                counts = pairs[:, above, own] + 5 * alone[:, None, :]
                table = counts / counts.sum(axis=2, keepdims=True)
            self.tables.append(table)

    def correlate(self, pairs: np.ndarray, least: float) -> None:
        """Parents: the tree of the largest mutual information of two voters given the class, edges above `least`."""
        total = max(1e-9, pairs[:, :STATES, :STATES].sum())
        share = np.zeros((VOTERS, VOTERS))
        for i in range(VOTERS):
            for j in range(i):
                both = pairs[:, STATES * i : STATES * (i + 1), STATES * j : STATES * (j + 1)] / total + 1e-12
                of_class = both.sum(axis=(1, 2), keepdims=True)
                share[i, j] = share[j, i] = (both * np.log(both * of_class / both.sum(axis=2, keepdims=True) / both.sum(axis=1, keepdims=True))).sum()
        self.parent[:] = -1
        left = set(range(VOTERS))
        while left:
            # A new root, then always the strongest edge to a voter that is not yet in the tree.
            tree = {left.pop()}
            while left:
                gain, above, below = max((share[a, b], a, b) for a in tree for b in left)
                if gain < least:
                    break
                self.parent[below] = above
                tree.add(below)
                left.remove(below)


def label_model(patterns: DataFrame, rounds: int, least: float) -> LabelModel:
    """Fitted to the counts of all patterns: first with voters independent given the class, then with their tree."""
    model = LabelModel()
    for step in range(2 * rounds):
        pairs, labels = model.expected(patterns)
        if not pairs.any():
            return model
        if step == rounds:
            model.correlate(pairs, least)
        before = model.prior
        model.update(pairs, labels)
        if step > rounds and np.abs(model.prior - before).max() < 1e-6:
            break
    return model


def features(votes: np.ndarray, strong: list[np.ndarray], terms: np.ndarray, width: int) -> np.ndarray:
    """Votes (fired, fired twice), strong units, length and a constant."""
    states = states_of(votes)
    units = np.zeros((len(votes), width), np.float32)
    for row, own in zip(units, strong):
        row[own] = 1
    rest = np.column_stack((np.log10(terms + 1.0), np.ones(len(votes))))
    return np.concatenate(((states > 0), (states > 1), units, rest), axis=1).astype(np.float32)


def logistic_regression(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps on weighted rows with targets between 0 and 1."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + penalty * beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        step = np.linalg.solve(curve + np.diag(penalty), gradient)
        beta -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return beta


def scored(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    lexicon_size: int = 2048,
    strong_units: int = 192,
    sample_rows: int = 4000,
    rounds: int = 6,
    least_correlation: float = 0.0005,
    ridge: float = 0.5,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    Reads `doc_id` and `text` of documents, `doc_id` and `toxic` of labels.
    """
    importable(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = known_labels(labels)
    voters = Voters(mined(rows, known, lexicon_size), strong_units)
    seen = stored(spark, voted(rows, voters), "toxicity-votes")
    labelled = seen.join(known, "doc_id", "left").select("votes", F.coalesce("toxic", F.lit(-1)).alias("label"))
    patterns = stored(spark, labelled.groupBy("votes", "label").count(), "toxicity-patterns")
    model = label_model(patterns, rounds, least_correlation)

    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = spread(["doc_id"])
    chosen = [thinned(known.filter(F.col("toxic") == y), ["doc_id"], sample_rows).orderBy(*order).limit(sample_rows) for y in (0, 1)]
    sample = seen.join(chosen[0].unionAll(chosen[1]), "doc_id").orderBy(*order, "votes").limit(2 * sample_rows)
    found = sample.select("votes", "strong", "terms", "toxic").collect()
    width, beta = len(voters.strong), None
    label = np.array([r["toxic"] for r in found], np.int64)
    if found and 0 < label.sum() < len(label):
        votes = np.array([r["votes"] for r in found], np.int64)
        x = features(votes, [np.array(r["strong"], np.int64) for r in found], np.array([r["terms"] for r in found]), width)
        target = model.toxic(states_of(votes), label)
        # The sample takes as many rows of either label; each stands for its share of all.
        weight = np.where(label == 1, totals.get(1, 0) / max(1, label.sum()), totals.get(0, 0) / max(1, (1 - label).sum()))
        beta = logistic_regression(x, target, weight * len(label) / max(1e-9, weight.sum()), ridge)
    shared = spark.sparkContext.broadcast((model, beta, width))

    def score(batches) -> Iterator[pa.RecordBatch]:
        model, beta, width = shared.value
        for batch in batches:
            votes, terms = batch.column("votes").to_numpy(), batch.column("terms").to_numpy()
            if beta is None:
                own = model.toxic(states_of(votes), np.full(len(votes), -1))
            else:
                strong = [np.array(s, np.int64) for s in batch.column("strong").to_pylist()]
                own = 1 / (1 + np.exp(-np.clip(features(votes, strong, terms, width) @ beta, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(own.astype(float)), pa.array((own >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = seen.select("doc_id", held_out().alias("held_out"), "votes", "strong", "terms")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
