"""Removal of repeated byte strings by a column-wise collection suffix array.

Which places of the corpus can begin a repeated string is found by anchors: in every window of
`length` bytes the leftmost of the smallest hashes of `length / 4` bytes. Equal windows
choose the same anchor at the same place in them, so only contexts of equal anchors are compared
(a context is all of the text that a window around the anchor can cover).

The contexts of one anchor are a collection of short texts, aligned at the anchor. It is built column by column
from the last one: each round puts one symbol in front of every suffix, re-orders the suffixes by
a stable distribution on that symbol (the collection's Burrows-Wheeler column) and carries the
common prefixes of neighbours along. A suffix that shares `length` symbols with a neighbour
begins a repeated window. Since equal windows are aligned, suffixes of one column need to be sorted
among themselves only. Collections arrive as sorted shuffle files, read once and in order; a
task holds one run of collections at a time.

A collection of more than `most_contexts` distinct contexts (a passage that very many documents share,
shorter than `length`) is split: the windows are cut into ranges of their offsets to the anchor, and all
windows of a range have a longer core in common, whose hash divides the collection; ranges of a core
that is still shared by many are cut again, down to whole windows. No row is dropped by it.

Copies of one text count as repetitions of it: a text with a copy has every window repeated. Null counts as empty; a text shorter than `length` has no window and stays. Rows with equal
text get equal results whatever their ids, null ids included. An empty table gives no rows. Other columns
are kept by `cleaned` and ignored by `marked`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.storage import free_name, importable, stored, tidy, utf8
from tributary.llm.text import batches_of_texts, mix, powers, prefix_hash
from tributary.operators.keyed import join_grouped

LENGTH = 400
# Distinct contexts that are sorted as one collection (some 22 MB of them at 400 bytes), and
# contexts of small collections that a task sorts at once.
MOST_CONTEXTS = 32_000
RUN_CONTEXTS = 8_000
# Ranges of offsets into which a large collection is split, step by step.
SPLIT = 8
# A byte that UTF-8 never has: stands for what lies outside of a text.
OUTSIDE = 0xFF
# Bits that hold a place within a block of text; the others hold the leading bits of a hash.
PLACE_BITS = 26
BLOCK = 1 << 25


class Shape:
    """Sizes that follow from the length of a window."""

    def __init__(self, length: int) -> None:
        if length < 8:
            raise ValueError("windows have at least 8 bytes")
        self.length = length
        self.anchor = length // 4
        # Bytes of a window before its anchor, at most; the same number of offsets, and one.
        self.before = length - self.anchor
        self.width = self.before + length


def anchors(data: np.ndarray, ends: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows that lie within one text.

    `ends` has the end of each text in `data`, in order.
    """
    n = len(data) - shape.length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = prefix_hash(data)
    _, down = powers(len(data))
    count = len(data) - shape.anchor + 1
    hashes = mix((sums[shape.anchor :] - sums[:-shape.anchor]) * down[:count])
    place_mask = np.uint64((1 << PLACE_BITS) - 1)
    keyed = (hashes & ~place_mask) | np.arange(count, dtype=np.uint64)
    # Smallest of every run of `span` keys: the ends of blocks of that size meet.
    span = shape.before + 1
    blocks = -(-count // span)
    padded = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:count] = keyed
    grid = padded.reshape(blocks, span)
    to_end = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    from_start = np.minimum.accumulate(grid, axis=1).reshape(-1)
    smallest = np.minimum(to_end[:n], from_start[span - 1 : span - 1 + n])
    starts = np.arange(n)
    text = np.searchsorted(ends, starts, side="right")
    inside = starts + shape.length <= ends[np.minimum(text, len(ends) - 1)]
    places = np.unique((smallest[inside] & place_mask).astype(np.int64))
    return places, hashes[places]


def anchor_rows(texts: list[bytes], shape: Shape) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per text with an anchor: its index, the anchors' places and hashes, hashes of their contexts."""
    for begin, end in batches_of_texts(texts):
        part = texts[begin:end]
        if len(part) == 1 and len(part[0]) > BLOCK:
            yield begin, *_long_text(part[0], shape)
            continue
        lengths = np.fromiter((len(t) for t in part), np.int64, len(part))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(part), np.uint8)
        places, hashes = anchors(data, ends, shape)
        cut = np.searchsorted(places, np.concatenate(([0], ends)))
        for i in range(end - begin):
            own = slice(cut[i], cut[i + 1])
            if cut[i] < cut[i + 1]:
                at = places[own] - (ends[i] - lengths[i])
                yield begin + i, at, hashes[own], _context_hashes(part[i], at, shape)


def _long_text(text: bytes, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text beyond BLOCK bytes, in blocks that overlap by a window."""
    places, hashes = [], []
    for at in range(0, len(text), BLOCK):
        block = np.frombuffer(text, np.uint8)[at : at + BLOCK + shape.length - 1]
        own, found = anchors(block, np.array([len(block)]), shape)
        places.append(own + at)
        hashes.append(found)
    every, first = np.unique(np.concatenate(places), return_index=True)
    return every, np.concatenate(hashes)[first], _context_hashes(text, every, shape)


def _context_hashes(text: bytes, places: np.ndarray, shape: Shape) -> np.ndarray:
    """Hash of each context and of where the anchor lies in it."""
    out = np.empty(len(places), np.uint64)
    for i, place in enumerate(places.tolist()):
        left = min(shape.before, place)
        out[i] = xxhash.xxh3_64_intdigest(text[place - left : place + shape.length], seed=left)
    return out


def context(text: bytes, place: int, shape: Shape) -> bytes:
    """The context as a row of `width` symbols, filled up with OUTSIDE."""
    left = min(shape.before, place)
    own = text[place - left : place + shape.length]
    return b"\xff" * (shape.before - left) + own + b"\xff" * (shape.length - (len(own) - left))


def repeated_offsets(rows: np.ndarray, first: int, last: int, length: int) -> np.ndarray:
    """Which columns first..last of each context begin a window that another row has there as well.

    Built from the last column to the first: order of the suffixes, and the common prefix of
    each with the one before it in that order.
    """
    m = len(rows)
    flags = np.zeros((m, last - first + 1), bool)
    if m < 2:
        return flags
    order = np.arange(m)
    # Column of the suffix where a neighbouring pair first differs is as far as `common` goes.
    common = np.zeros(m + 1, np.int32)
    columns = np.ascontiguousarray(rows[:, first : last + length].T)
    for column in range(last + length - 1, first - 1, -1):
        symbols = columns[column - first][order]
        moved = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[moved]
        same = np.flatnonzero(sorted_symbols[1:] == sorted_symbols[:-1])
        longer = np.zeros(m + 1, np.int32)
        if len(same):
            # Least common prefix between the two old places: of all old neighbours in between.
            pairs = np.stack([moved[same] + 1, moved[same + 1] + 1], axis=1).reshape(-1)
            longer[same + 1] = np.minimum.reduceat(common, pairs)[::2] + 1
        # OUTSIDE never matches: a suffix that begins there has nothing in common.
        longer[:-1][sorted_symbols == OUTSIDE] = 0
        order, common = order[moved], longer
        if column <= last:
            enough = common >= length
            hit = enough[:-1] | enough[1:]
            flags[order[hit], column - first] = True
    return flags


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs (first, last) of set places."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def parts_of(first: int, last: int) -> list[tuple[int, int]]:
    """The columns first..last in at most SPLIT runs."""
    count = last - first + 1
    edges = sorted({first + count * i // SPLIT for i in range(SPLIT + 1)})
    return [(a, b - 1) for a, b in zip(edges, edges[1:])]


# The digest of texts of which there is one row each.
DISTINCT = "distinct_text_key"
ANCHORS = "text_key binary, anchors array<long>, contexts array<long>, places array<int>"
MEMBERS = "anchor long, context long, symbols binary"
FOUND = "anchor long, context long, runs array<struct<first: int, last: int>>"


def _keyed(docs: DataFrame) -> DataFrame:
    """text and its key, a 128-bit digest: copies of a text are one text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.unhex(F.md5(text)).alias("text_key"), text.alias("text"))


def _anchor_table(spark: SparkSession, docs: DataFrame, shape: Shape) -> DataFrame:
    """All anchors, one row per text that has any; stored."""

    def find(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), utf8(batch.column(1))
            owner, places, hashes, contexts = [], [], [], []
            for i, at, own, around in anchor_rows(texts, shape):
                owner.append(i)
                places.append(at.astype(np.int32))
                hashes.append(own.view(np.int64))
                contexts.append(around.view(np.int64))
            if owner:
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(owner)), pa.array(hashes, longs), pa.array(contexts, longs), pa.array(places, pa.list_(pa.int32()))],
                    names=["text_key", "anchors", "contexts", "places"],
                )

    return stored(spark, _keyed(docs).mapInArrow(tidy(find), ANCHORS), "anchors")


def _joined(texts: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Left join by the digest; where texts may have many copies, one that may split them.

    Distinct texts are partitioned by their digest already.
    """
    return texts.join(others, key, "left") if key == DISTINCT else join_grouped(texts, others, [key])


def _fetched(texts: DataFrame, wanted: DataFrame, shape: Shape, key: str) -> DataFrame:
    """The contexts (MEMBERS) of `wanted`: text_key, anchor, context, place.

    All columns of `texts` are read, and kept by a left join, so that a caller who joins the same
    texts once more shuffles them only once. Copies of a text come after one another; one of them counts.
    """
    asked = free_name(texts, "wanted")
    per_text = wanted.groupBy(F.col("text_key").alias(key)).agg(F.collect_list(F.struct("anchor", "context", "place")).alias(asked))

    def cut(batches) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["anchor", "context", "symbols"])

        held: list[tuple] = []
        before = None
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            has = pa.compute.indices_nonzero(column[asked].is_valid())
            keys, rows_of = column[key].take(has).to_pylist(), column[asked].take(has).to_pylist()
            for own, text, rows in zip(keys, utf8(column["text"].take(has)), rows_of):
                if own == before:
                    continue
                before = own
                for row in rows:
                    held.append((row["anchor"], row["context"], context(text, row["place"], shape)))
                    if len(held) * shape.width > 8 << 20:
                        yield batch_of(held)
                        held = []
        if held:
            yield batch_of(held)

    return _joined(texts, per_text, key).mapInArrow(tidy(cut), MEMBERS)


def _sorted_collections(members: DataFrame, key: list[str], shape: Shape) -> DataFrame:
    """Repeated windows (FOUND) of collections: members of equal `key`, with the columns `first` to
    `last` at which their windows begin."""

    def search(batches) -> Iterator[pa.RecordBatch]:
        def finish(rows: list[tuple]):
            by_range: dict[tuple[int, int], list[tuple]] = {}
            for row in rows:
                by_range.setdefault(row[:2], []).append(row)
            found = []
            for (first, last), own in by_range.items():
                symbols = np.frombuffer(b"".join(r[4] for r in own), np.uint8).reshape(len(own), shape.width)
                flags = repeated_offsets(symbols, first, last, shape.length)
                for i in np.flatnonzero(flags.any(axis=1)):
                    found.append((own[i][2], own[i][3], [{"first": a + first, "last": b + first} for a, b in runs_of(flags[i])]))
            if found:
                kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
                columns = [pa.array([f[0] for f in found]), pa.array([f[1] for f in found]), pa.array([f[2] for f in found], kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "context", "runs"])

        held: list[tuple] = []
        last_key = None
        for batch in batches:
            names = batch.schema.names
            keys = list(zip(*(batch.column(names.index(k)).to_pylist() for k in key)))
            columns = [batch.column(names.index(c)).to_pylist() for c in ("first", "last", "anchor", "context", "symbols")]
            for own, *row in zip(keys, *columns):
                # A run ends between collections, never within one.
                if own != last_key and len(held) >= RUN_CONTEXTS:
                    yield from finish(held)
                    held = []
                last_key = own
                held.append(tuple(row))
        yield from finish(held)

    return members.repartition(*key).sortWithinPartitions(*key).mapInArrow(tidy(search), FOUND)


def _cores(members: DataFrame, shape: Shape) -> DataFrame:
    """anchor, context, first, last, core: the range of each member cut into SPLIT parts, and per part
    the hash of what all windows of the part have in common.

    With one column the core is the window. Parts in which the text has no window are left out.
    """

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            take, firsts, lasts, cores = [], [], [], []
            rows = zip(*(batch.column(names.index(c)).to_pylist() for c in ("symbols", "first", "last")))
            for i, (symbols, first, last) in enumerate(rows):
                left = len(symbols) - len(symbols.lstrip(b"\xff"))
                right = len(symbols.rstrip(b"\xff"))
                for a, b in parts_of(first, last):
                    if b >= left and a + shape.length <= right:
                        take.append(i)
                        firsts.append(a)
                        lasts.append(b)
                        cores.append(xxhash.xxh3_128_digest(symbols[b : a + shape.length]))
            own = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(names.index(c)).take(own) for c in ("anchor", "context")),
                 pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32()), pa.array(cores, pa.binary())],
                names=["anchor", "context", "first", "last", "core"],
            )

    return members.mapInArrow(tidy(cut), "anchor long, context long, first int, last int, core binary")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """DISTINCT, text: one row per text; copies are merged in the map tasks first."""
    return _keyed(docs).withColumnRenamed("text_key", DISTINCT).groupBy(DISTINCT).agg(F.first("text").alias("text"))


def repeated_windows(spark: SparkSession, docs: DataFrame, texts: DataFrame, key: str, shape: Shape, most_contexts: int) -> DataFrame:
    """text_key, place, runs: per anchor the offsets of repeated windows (counted from `before` bytes before it).

    `texts` has the texts of `docs` and their digests, as column `key`.
    """
    table = _anchor_table(spark, docs, shape)
    each = table.select("text_key", F.explode(F.arrays_zip("anchors", "contexts", "places")).alias("at")).select(
        "text_key", F.col("at.anchors").alias("anchor"), F.col("at.contexts").alias("context"), F.col("at.places").alias("place")
    )
    per_anchor = (
        each.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("total"), (F.min("context") == F.max("context")).alias("uniform"))
        .filter("total > 1")
        .drop("total")
    )
    # Places whose anchor is elsewhere too; copies of a text become one row with their number.
    repeated = (
        join_grouped(each, per_anchor, ["anchor"], "inner")
        .groupBy("text_key", "anchor", "context", "place", "uniform")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    repeated = stored(spark, repeated, "repeated-anchors")
    # All contexts of the anchor are equal: every window around it is repeated.
    every = F.array(F.struct(F.lit(0).alias("first"), F.lit(shape.before).alias("last")))
    alike = repeated.filter("uniform").select("text_key", "place", every.alias("runs"))

    several = repeated.filter("NOT uniform")
    contexts = several.groupBy("anchor", "context").agg(F.sum("copies").alias("copies"), F.min(F.struct("text_key", "place")).alias("one"))
    contexts = stored(spark, contexts, "contexts")
    found = contexts.filter("copies > 1").select("anchor", "context", every.alias("runs"))
    wanted = contexts.select("one.text_key", "anchor", "context", "one.place")
    large = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > most_contexts)
    large = stored(spark, large.select("anchor"), "large-anchors")
    if not large.isEmpty():
        split = join_grouped(wanted, large, ["anchor"], "left_semi")
        found = found.unionAll(_of_split_collections(spark, stored(spark, _fetched(texts, split, shape, key), "members"), shape, most_contexts))
        wanted = wanted.join(large, "anchor", "left_anti")
    members = _fetched(texts, wanted, shape, key).withColumns({"first": F.lit(0), "last": F.lit(shape.before)})
    found = found.unionAll(_sorted_collections(members, ["anchor"], shape))
    runs = found.groupBy("anchor", "context").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return alike.unionAll(join_grouped(several, runs, ["anchor", "context"], "inner").select("text_key", "place", "runs"))


def _of_split_collections(spark: SparkSession, members: DataFrame, shape: Shape, most_contexts: int) -> DataFrame:
    """Repeated windows (FOUND) of large collections, given their stored members.

    Cores that are shared by few members are collections of their own; ranges of a core that is
    shared by many are cut further, down to single windows.
    """
    member = ["anchor", "context"]
    core = ["first", "last", "core"]
    ranges = members.select(*member, F.lit(0).alias("first"), F.lit(shape.before).alias("last"))
    found = None
    while True:
        cores = stored(spark, _cores(members.join(ranges, member), shape), "cores")
        count = cores.groupBy(*core).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        shared = stored(spark, join_grouped(cores, count, core, "inner"), "shared-cores")
        # Whole windows: equal hash, equal window.
        run = F.array(F.struct("first", "last"))
        here = shared.filter("first = last").select(*member, run.alias("runs"))
        small = shared.filter((F.col("first") < F.col("last")) & (F.col("size") <= most_contexts))
        here = here.unionAll(_sorted_collections(members.join(small, member), ["core", "first"], shape))
        found = here if found is None else found.unionAll(here)
        ranges = shared.filter((F.col("first") < F.col("last")) & (F.col("size") > most_contexts)).select(*member, "first", "last")
        if ranges.isEmpty():
            return found


def _spans(place: np.ndarray, first: np.ndarray, last: np.ndarray, size: int, shape: Shape) -> list[tuple[int, int]]:
    """Maximal covered runs [begin, end) of a text of `size` bytes."""
    begin = np.maximum(place - shape.before + first, 0)
    # Windows that would reach beyond the text do not exist.
    final = np.minimum(place - shape.before + last, size - shape.length)
    begin, final = begin[final >= begin], final[final >= begin]
    order = np.argsort(begin, kind="stable")
    spans: list[list[int]] = []
    for a, b in zip(begin[order].tolist(), (final[order] + shape.length).tolist()):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return [tuple(s) for s in spans]


def windows_per_text(spark: SparkSession, docs: DataFrame, texts: DataFrame, key: str, length: int, most_contexts: int) -> DataFrame:
    """text_key, windows: of each text with a repeated window, the places and runs that say where."""
    windows = repeated_windows(importable(spark), docs, texts, key, Shape(length), most_contexts)
    return windows.groupBy("text_key").agg(F.collect_list(F.struct("place", "runs")).alias("windows"))


def spans_of(size: int, windows: list[dict] | None, shape: Shape) -> list[tuple[int, int]]:
    """Maximal repeated runs [begin, end) of a text of `size` bytes."""
    rows = [(w["place"], r["first"], r["last"]) for w in windows or () for r in w["runs"]]
    return _spans(*np.array(rows, np.int64).T, size, shape) if rows else []


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, done = [], 0
    for begin, end in spans:
        kept.append(text[done:begin])
        done = end
    kept.append(text[done:])
    return b"".join(kept)


def cleaned(spark: SparkSession, docs: DataFrame, length: int = LENGTH, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """`docs` with the repeated strings cut out of `text`; nothing else changes.

    A cut within a character drops the rest of that character; a null text stays null.
    """
    shape, columns = Shape(length), docs.columns
    key, found = free_name(docs, "any_text_key"), free_name(docs, "windows")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Shuffled once: contexts are fetched from it, and the windows found are joined to it.
    keyed = docs.withColumn(key, F.unhex(F.md5(text)))
    windows = windows_per_text(spark, docs, keyed, key, length, most_contexts)
    windows = windows.select(F.col("text_key").alias(key), F.col("windows").alias(found))
    joined = join_grouped(keyed, windows, [key]).select(*columns, found)
    place = columns.index("text")

    def apply(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(batch.num_columns - 1).to_pylist()
            texts = batch.column(place).to_pylist()
            for i, own in enumerate(hits):
                if own:
                    data = texts[i].encode()
                    texts[i] = without(data, spans_of(len(data), own, shape)).decode(errors="ignore")
            out = [pa.array(texts, pa.string()) if n == place else batch.column(n) for n in range(len(columns))]
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return joined.mapInArrow(tidy(apply), docs.schema)


RESULT = "text_key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin: long, end: long>>"


def marked(
    spark: SparkSession, docs: DataFrame, length: int = LENGTH, most_contexts: int = MOST_CONTEXTS, with_text: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans of each document.

    With `with_text` also `text`, what is left of it, without the bytes of characters that were cut through.
    """
    shape = Shape(length)
    texts = distinct_texts(docs)
    windows = windows_per_text(spark, docs, texts, DISTINCT, length, most_contexts)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def measure(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = utf8(batch.column(1))
            spans = [spans_of(len(t), w, shape) for t, w in zip(data, batch.column(2).to_pylist())]
            kept = [without(t, s) for t, s in zip(data, spans)]
            columns = [
                batch.column(0), pa.array(list(map(len, data)), pa.int64()),
                pa.array([len(t) - len(k) for t, k in zip(data, kept)], pa.int64()),
                pa.array(list(map(len, spans)), pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                pa.array([[{"begin": a, "end": b} for a, b in s] for s in spans], kind),
            ]
            names = ["text_key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if with_text:
                columns.append(pa.array([k.decode(errors="ignore") for k in kept], pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    windows = windows.withColumnRenamed("text_key", DISTINCT)
    results = _joined(texts, windows, DISTINCT).select(DISTINCT, "text", "windows")
    results = results.mapInArrow(tidy(measure), RESULT + ", text string" * with_text)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"))
    return join_grouped(rows, results, ["text_key"], "inner").drop("text_key")
