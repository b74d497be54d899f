"""Jaccard join of word shingles with a count-vector R-tree.

A document is the set of hashes of its shingles. Documents with equal sets form a class; classes are
joined, copies are not expanded. Two sets that are similar enough share a shingle among the first
ones of each in one common order, so classes meet in buckets of these shingles. The order is by
the bytes of a shingle, the longest first, and then by hash: long shingles are rare, so
texts that have little in common seldom meet. In a bucket a class is a point: its shingles are dealt to groups by hash, the
coordinates are the numbers per group. An R-tree over the points finds partners: the sum of the minima of a
point's coordinates and a node's upper corner bounds the overlap with everything below the
node. Pairs whose own bound passes are verified on their complete sets.

A bucket does not emit all its pairs: it emits a spanning forest of them, one per partner not yet reached. What
forests connect is a cluster; every pair whose bound passes lies in one. If verification refuses an edge of a
cluster, its classes are searched once more with their complete sets at hand: pairs are verified
in the task, only true links join labels, and again a forest of them is all that is emitted.
So what leaves a task is never more than its members, and no link between components is lost. Buckets with equal
members are searched once. A bucket or cluster of more than `most_members` is cut into blocks (by size of the sets
and by hash), and every pair of blocks that can hold a link is searched by a task of its own.

A set is empty for a null text or one without words, and linked with nothing. Rows with null or
repeated ids are documents of their own; a component's id is the smallest non-null id in
it. An empty table gives no rows. Other columns are kept by `representatives`, and ignored by `linked`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.components import components
from tributary.llm.storage import free_name, importable, stored, tidy, utf8
from tributary.llm.text import hashed_words, shingle_hashes
from tributary.operators.keyed import join_grouped

GROUPS = 256
LEAF = 32
# Members up to which a bucket emits all its candidate pairs.
SMALL = 12
# Members that one task searches as one tree.
MOST_MEMBERS = 3000
# Where complete sets are at hand, so many shingles count as a member.
SHINGLES_A_MEMBER = 1024
# Partners whose sets are compared at once.
COMPARED = 64
# What names a pair of blocks of a large bucket: the classes of sizes, and a block of each.
BLOCKS = ["c", "d", "i", "j"]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    return np.unique(shingle_hashes(words, size))


def first_shingles(n: int, percent: int) -> int:
    """How many of the first shingles a set of n needs to meet every similar set in one of them."""
    return n - -(-percent * n // 100) + 1 if n else 0


def leading(words: np.ndarray, lengths: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The set, and its first shingles in the common order: by length, the longest first, then by hash."""
    hashes = shingle_hashes(words, size)
    own, at = np.unique(hashes, return_index=True)
    if not len(own):
        return own, own
    total = np.concatenate(([0], np.cumsum(lengths)))
    width = min(size, len(words))
    bytes_ = np.minimum(total[at + width] - total[at], 255).astype(np.uint64)
    order = ((np.uint64(255) - bytes_) << np.uint64(56)) | (own >> np.uint64(8))
    count = first_shingles(len(own), percent)
    return own, own[np.argpartition(order, count - 1)[:count]] if count < len(own) else own


def point(shingles: np.ndarray) -> np.ndarray:
    """Shingles per group."""
    return np.bincount((shingles & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


def packed_point(counts: np.ndarray) -> bytes:
    """One byte per group if they suffice, else four."""
    return counts.astype("u1" if counts.max(initial=0) < 256 else "<u4").tobytes()


def unpacked_points(rows: list[bytes]) -> np.ndarray:
    out = np.empty((len(rows), GROUPS), np.int32)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(row, "u1" if len(row) == GROUPS else "<u4")
    return out


class Tree:
    """R-tree over count vectors; rows are packed by set size, then by their first coordinates."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray, percent: int) -> None:
        self.percent = percent
        slab = max(LEAF, int(np.sqrt(len(sizes) / LEAF)) * LEAF)
        by_size = np.argsort(sizes, kind="stable")
        lead = points[by_size, : GROUPS // 8].sum(axis=1)
        self.rows = by_size[np.lexsort((lead, np.arange(len(sizes)) // slab))]
        self.sizes, self.points = sizes[self.rows], points[self.rows]
        # Levels from the leaves up: upper corners, smallest and largest set size.
        self.levels = []
        upper, low, high = self.points, self.sizes, self.sizes
        while len(low) > LEAF or not self.levels:
            starts = np.arange(0, len(low), LEAF)
            upper = np.maximum.reduceat(upper, starts, axis=0)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((upper, low, high))

    def below(self, nodes: np.ndarray, count: int) -> np.ndarray:
        under = (nodes[:, None] * LEAF + np.arange(LEAF)).reshape(-1)
        return under[under < count]

    def partners(self, size: int, own: np.ndarray, labels: np.ndarray, label: int) -> np.ndarray:
        """Rows outside of `label` whose bound with the set passes; `labels` in the tree's order."""
        p = self.percent
        nodes = np.arange(len(self.levels[-1][1]))
        for level in range(len(self.levels) - 1, -1, -1):
            upper, low, high = (x[nodes] for x in self.levels[level])
            # The least size a partner below can have decides how much overlap is needed.
            least = np.maximum(low, -(-p * size // 100))
            fits = (100 * high >= p * size) & (p * low <= 100 * size)
            fits &= (100 + p) * np.minimum(upper, own).sum(axis=1) >= p * (size + least)
            count = len(self.levels[level - 1][1]) if level else len(self.sizes)
            nodes = self.below(nodes[fits], count)
            if not len(nodes):
                return nodes
        nodes = nodes[labels[nodes] != label]
        sizes = self.sizes[nodes]
        fits = (100 * sizes >= p * size) & (p * sizes <= 100 * size)
        nodes = nodes[fits]
        bound = np.minimum(self.points[nodes], own).sum(axis=1)
        return nodes[(100 + p) * bound >= p * (size + self.sizes[nodes])]


def overlaps(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements each of `others` shares with `own`; all sorted and without repeats."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    begins = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat(own[at] == flat, begins, dtype=np.int64)


def bucket_pairs(ids, sizes, points, labels, sides, percent: int, forest: bool, sets: list[np.ndarray] | None = None) -> Iterator[tuple[int, int]]:
    """Candidate pairs of one bucket between different labels (and sides, if there are two).

    As a forest, pairs found join their labels, and later rows skip what is joined. Without it
    all pairs come once. With `sets` only true links come.
    """
    tree = Tree(sizes, points, percent)
    place = np.empty(len(ids), np.int64)
    place[tree.rows] = np.arange(len(ids))
    own_labels, own_sides, own_ids = labels[tree.rows].copy(), sides[tree.rows], ids[tree.rows]
    two = bool(sides.min() != sides.max())
    alone = np.unique(own_labels).size
    for row in np.argsort(ids, kind="stable"):
        if alone == 1:
            return
        at = place[row]
        found = tree.partners(int(sizes[row]), points[row], own_labels, own_labels[at])
        if two:
            found = found[own_sides[found] != own_sides[at]]
        if not forest or sets is not None:
            # Each pair is looked at from its smaller end.
            found = found[own_ids[found] > own_ids[at]]
        while len(found):
            some, found = (found, found[:0]) if sets is None else (found[:COMPARED], found[COMPARED:])
            if sets is not None:
                both = overlaps(sets[row], [sets[tree.rows[o]] for o in some])
                some = some[(100 + percent) * both >= percent * (sizes[row] + tree.sizes[some])]
            for other in some:
                if forest:
                    if own_labels[other] == own_labels[at]:
                        continue
                    own_labels[own_labels == own_labels[other]] = own_labels[at]
                    alone -= 1
                a, b = int(ids[row]), int(own_ids[other])
                yield (a, b) if a < b else (b, a)
            found = found[own_labels[found] != own_labels[at]]


def _set_rows(spark: SparkSession, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_key, set_key, n, first shingles and point of each document; stored, as all texts are read and hashed for it."""
    names = ["doc_id", "text_key", "set_key", "n", "firsts", "point"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def find(batches) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, held = [], 0
            for i, hashes, lengths in hashed_words(utf8(batch.column(2)), fold_case=True, lengths=True):
                own, firsts = leading(hashes, lengths, words, percent)
                key = xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None
                rows.append((ids[i], keys[i], key, len(own), firsts.view(np.int64), packed_point(point(own))))
                held += len(firsts)
                if held > 1 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text"))
    kind = "doc_id long, text_key binary, set_key binary, n long, firsts array<long>, point binary"
    return stored(spark, source.mapInArrow(tidy(find), kind), "set-rows")


def _classes(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Distinct non-empty sets of `_set_rows`, numbered by `id` and stored, with their smallest document."""
    one = rows.filter("n > 0").groupBy("set_key").agg(
        F.first("n").alias("n"), F.first("firsts").alias("firsts"), F.first("point").alias("point"),
        F.min("text_key").alias("text_key"), F.min("doc_id").alias("least"),
    )
    return stored(spark, one.withColumn("id", F.monotonically_increasing_id()), "set-classes")


def _buckets(spark: SparkSession, classes: DataFrame, percent: int) -> DataFrame:
    """bucket, id, n, members: rows of buckets in which sizes allow a pair; equal buckets once."""
    rows = classes.select(F.explode("firsts").alias("bucket"), "id", "n")
    order = Window.partitionBy("bucket").orderBy("n")
    near = F.coalesce(100 * F.lag("n").over(order) >= percent * F.col("n"), F.lit(False))
    near = near | F.coalesce(100 * F.col("n") >= percent * F.lead("n").over(order), F.lit(False))
    rows = stored(spark, rows.withColumn("near", near).filter("near").drop("near"), "bucket-rows")
    members = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")
    )
    chosen = members.groupBy("members", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "members")
    return stored(spark, join_grouped(rows, chosen, ["bucket"], "inner"), "buckets")


def _searches(spark: SparkSession, buckets: DataFrame, percent: int, most_members: int) -> DataFrame:
    # `members` is the sum of the weights of a bucket's rows, 1 each if there is no such column.
    if "weight" not in buckets.columns:
        buckets = buckets.withColumn("weight", F.lit(1))
    """search, c, d, i, j, side, id, n, members: what is searched together; large buckets as pairs of blocks (classes c, d, blocks i, j)."""
    whole = buckets.filter(F.col("members") <= most_members).select(
        F.col("bucket").alias("search"), *(F.lit(0).cast("long").alias(x) for x in BLOCKS), F.lit(0).alias("side"), "id", "n", "members"
    )
    large = buckets.filter(F.col("members") > most_members)
    if large.isEmpty():
        return whole
    # Similar sets lie in the same or in neighbouring classes of sizes.
    step = float(np.log(100 / percent)) + 1e-9
    large = large.withColumn("class", F.floor(F.log("n") / step))
    blocks = large.groupBy("bucket", "class").agg(F.ceil(F.sum("weight") / (most_members / 2)).alias("blocks"))
    up = blocks.select("bucket", (F.col("class") - 1).alias("class"), F.col("blocks").alias("above"))
    down = blocks.select("bucket", (F.col("class") + 1).alias("class"), F.col("blocks").alias("beneath"))
    counts = blocks.join(up, ["bucket", "class"], "left").join(down, ["bucket", "class"], "left")
    placed = join_grouped(large, counts, ["bucket", "class"], "inner").withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")))

    def numbers(count: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.coalesce(count, F.lit(0)).cast("int")), lambda i: i < F.coalesce(count, F.lit(0)))

    own, at = F.col("own").cast("long"), F.col("class").cast("long")
    within = F.transform(numbers(F.col("blocks")), lambda j: F.struct(at.alias("c"), at.alias("d"), F.least(own, j.cast("long")).alias("i"), F.greatest(own, j.cast("long")).alias("j"), (own > j).cast("int").alias("side")))
    higher = F.transform(numbers(F.col("above")), lambda j: F.struct(at.alias("c"), (at + 1).alias("d"), own.alias("i"), j.cast("long").alias("j"), F.lit(0).alias("side")))
    lower = F.transform(numbers(F.col("beneath")), lambda j: F.struct((at - 1).alias("c"), at.alias("d"), j.cast("long").alias("i"), own.alias("j"), F.lit(1).alias("side")))
    cut = placed.select("bucket", "id", "n", "members", F.explode(F.concat(within, higher, lower)).alias("t"))
    return whole.unionAll(
        cut.select(F.col("bucket").alias("search"), *(F.col(f"t.{x}").alias(x) for x in BLOCKS), F.col("t.side").alias("side"), "id", "n", "members")
    )


def _candidates(searches: DataFrame, classes: DataFrame, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """Distinct pairs a < b of all searches; `searches` may carry the labels of known components.

    With `sets` the pairs are true links, else pairs whose bound passes: a forest of them, in small buckets all.
    """
    if "label" not in searches.columns:
        searches = searches.withColumn("label", F.col("id"))
    verify = sets is not None
    rows = searches.join(classes.select("id", "point"), "id")
    if verify:
        rows = rows.join(sets, "id")
    rows = rows.select("search", *BLOCKS, "side", "id", "n", "members", "label", "point", *(["shingles"] if verify else []))
    by = ["search", *BLOCKS]

    def search(batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple[int, int]] = []

        def find(rows: pa.Table):
            column = lambda c: rows.column(c).to_numpy()
            keys = np.stack([column(c) for c in by])
            edges = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
            points = unpacked_points(rows.column("point").to_pylist())
            ids, sizes, labels, sides, members = (column(c) for c in ("id", "n", "label", "side", "members"))
            complete = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()] if verify else None
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                if b - a > 1:
                    own = complete[a:b] if verify else None
                    tree = verify or members[a] > SMALL
                    yield from bucket_pairs(ids[a:b], sizes[a:b], points[a:b], labels[a:b], sides[a:b].astype(np.int64), percent, tree, own)

        def flush(rows: pa.Table):
            for pair in find(rows):
                out.append(pair)
                if len(out) >= 1 << 16:
                    yield batch_of()
            if out:
                yield batch_of()

        def batch_of() -> pa.RecordBatch:
            pairs = np.array(sorted(set(out)), np.int64).T
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        # Rows come sorted by search; the last one of a batch may go on in the next.
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(c).to_numpy() for c in by)))
            last = len(keys)
            while last and keys[last - 1] == keys[-1]:
                last -= 1
            if last:
                yield from flush(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from flush(pa.Table.from_batches(held))

    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(tidy(search), "a long, b long").distinct()


def _sets_of(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """id, shingles (sorted hashes) of all classes in `pairs`; stored."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.unhex(F.md5(text)).alias("text_key"), text.alias("text")).groupBy("text_key").agg(F.first("text").alias("text"))
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = classes.select("id", "text_key").join(ids, "id")

    def find(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows, held = [], 0
            for i, hashes in hashed_words(utf8(batch.column(1)), fold_case=True):
                rows.append((ids[i], shingle_set(hashes, words).tobytes()))
                held += len(rows[-1][1])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["id", "shingles"])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["id", "shingles"])

    return stored(spark, texts.join(wanted, "text_key").select("id", "text").mapInArrow(tidy(find), "id long, shingles binary"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`pairs` with `linked`, decided on complete sets."""

    def compare(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
            linked = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y)
                common = both - len(np.union1d(x, y))
                linked.append(100 * common >= percent * (both - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    # A forest's edges share their smaller end more often than the larger: that one is joined last.
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    joined = pairs.join(right, "b").join(left, "a")
    return joined.select("a", "b", "left", "right").mapInArrow(tidy(compare), "a long, b long, linked boolean")


def class_components(
    spark: SparkSession, docs: DataFrame, set_rows: DataFrame, words: int, percent: int, most_members: int = MOST_MEMBERS
) -> DataFrame:
    """set_key, component (id of the smallest class in it), least (smallest document) of every class; `set_rows` are those of `docs`."""
    classes = _classes(spark, set_rows)
    buckets = _buckets(spark, classes, percent)
    pairs = stored(spark, _candidates(_searches(spark, buckets, percent, most_members), classes, percent), "pairs")
    sets = _sets_of(spark, docs, classes, pairs, words)
    verified = stored(spark, _verified(pairs, sets, percent), "verified")
    known = components(spark, verified.filter("linked").select("a", "b"))
    refused = verified.filter("NOT linked").select(F.col("a").alias("node"))
    if not refused.isEmpty():
        # Clusters with a refused edge, as buckets of their classes.
        clusters = stored(spark, components(spark, pairs), "clusters")
        broken = clusters.join(refused.distinct(), "node").select("root").distinct()
        rows = join_grouped(clusters, broken, ["root"], "left_semi").select(F.col("root").alias("bucket"), F.col("node").alias("id"))
        weight = F.greatest(F.lit(1), F.ceil(F.col("n") / SHINGLES_A_MEMBER))
        rows = stored(spark, rows.join(classes.select("id", "n"), "id").withColumn("weight", weight), "broken-clusters")
        size = rows.groupBy("bucket").agg(F.sum("weight").alias("members"))
        again = _searches(spark, join_grouped(rows, size, ["bucket"], "inner"), percent, most_members)
        labels = known.select(F.col("node").alias("id"), F.col("root").alias("label"))
        again = again.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        more = stored(spark, _candidates(again, classes, percent, sets), "more-links")
        if not more.isEmpty():
            # The stars found so far stand for their links.
            known = components(spark, known.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more))
    rooted = classes.select("set_key", "id", "least").join(known.select(F.col("node").alias("id"), "root"), "id", "left")
    rooted = rooted.withColumn("component", F.coalesce("root", "id")).drop("root")
    least = rooted.groupBy("component").agg(F.min("least").alias("first"))
    return join_grouped(rooted, least, ["component"], "inner").select("set_key", "component", F.col("first").alias("least"))


def linked(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80, most_members: int = MOST_MEMBERS) -> DataFrame:
    """doc_id, n_shingles, component_id of each document."""
    rows = _set_rows(importable(spark), docs, words, percent)
    found = class_components(spark, docs, rows, words, percent, most_members)
    rows = rows.select("doc_id", "n", "set_key")
    joined = join_grouped(rows, found, ["set_key"])
    # An empty set is a component of its own.
    own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def representatives(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with the columns of `docs`; empty sets stay.

    The row with the smallest id stays (null ids come last), of equal ids that with the smallest digest of
    its text, and of rows equal in both one. What goes is a small stored table of ids and
    digests, so Spark can broadcast it if its size allows; the texts need not be shuffled for it.
    """
    rows = _set_rows(importable(spark), docs, words, percent)
    found = stored(spark, class_components(spark, docs, rows, words, percent), "components")
    rows = rows.select("doc_id", "text_key", "set_key")
    named = join_grouped(rows, found.select("set_key", "component"), ["set_key"], "inner").select("component", "doc_id", "text_key")
    # Only components of several documents can lose one.
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    best = named.groupBy("component").agg(F.min(own).alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    member = join_grouped(named, best, ["component"], "inner")
    is_best = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key"))
    gone = stored(spark, member.filter(~is_best).select("doc_id", "text_key").distinct(), "near-copies")
    key, other, digest = free_name(docs, "text_key"), free_name(docs, "other_id"), free_name(docs, "other_key")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn(key, F.unhex(F.md5(text)))
    gone = gone.select(F.col("doc_id").alias(other), F.col("text_key").alias(digest))
    same = (F.col(key) == F.col(digest)) & F.col("doc_id").cast("long").eqNullSafe(F.col(other))
    kept = keyed.join(gone, same, "left_anti")
    repeats = member.filter(is_best).groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    repeats = stored(spark, repeats.select(F.col("doc_id").alias(other), F.col("text_key").alias(digest)), "repeated-rows")
    if repeats.isEmpty():
        return kept.select(*docs.columns)
    # Rows equal in id and text: of those that represent a component one stays.
    rank = free_name(docs, "rank")
    first = F.row_number().over(Window.partitionBy("doc_id", key).orderBy(F.lit(0))) == 1
    single = kept.join(repeats, same, "left_semi").withColumn(rank, first).filter(rank)
    return kept.join(repeats, same, "left_anti").select(*docs.columns).unionAll(single.select(*docs.columns))
