"""Exact deduplication by Grace hashing.

Every map task first merges equal texts of its own (a hot text leaves a task as one record),
then the remaining records are dealt to partitions by a hash of their content. A partition
is read into an open-addressing table that compares complete contents; one that does not
fit is dealt to spill files by another hash, recursively, until each fits. Spill files are
private to an attempt, lie in the shared folder and are removed when they have been read.

Two texts are equal when they are identical after lower-casing A-Z only; null counts as
empty. The row with the largest doc_id stays (a null id is smaller than any other); of rows
that share text and largest id exactly one stays. An empty table gives no rows. Other
columns, whatever their names, are kept by `deduplicated` and ignored by `groups`.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.storage import free_name, importable, join_path, open_folder, stored, tidy, utf8
from tributary.operators.keyed import join_grouped
from tributary.session import scratch_dir

# Bytes of distinct content that one table may hold.
TABLE_BYTES = 64 << 20
FANOUT = 16
NO_ID = -(1 << 63)

# content, largest id, rows with that id, rows
Record = tuple[bytes, int, int, int]


def normalised(text: bytes) -> bytes:
    """UTF-8 with A-Z in lower case; other letters are multi-byte and stay."""
    return text.lower()


class ContentTable:
    """Open addressing with linear probing; a slot matches only if all bytes are equal."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.entries: list[list] = []
        self.bytes = 0

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for entry, value in enumerate(self.hashes):
            at = value & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def add(self, record: Record) -> None:
        content, top, ties, count = record
        value = xxhash.xxh3_64_intdigest(content)
        mask = len(self.slots) - 1
        at = value & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == value and self.entries[entry][0] == content:
                found = self.entries[entry]
                found[3] += count
                if top > found[1]:
                    found[1], found[2] = top, ties
                elif top == found[1]:
                    found[2] += ties
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        self.hashes.append(value)
        self.entries.append([content, top, ties, count])
        self.bytes += len(content) + 200
        if 2 * len(self.entries) > len(self.slots):
            self._grow()


def merged_locally(records: Iterable[Record], table_bytes: int) -> Iterator[list]:
    """Equal records of one task merged; a full table is handed on and begun again."""
    table = ContentTable()
    for record in records:
        table.add(record)
        if table.bytes > table_bytes:
            yield from table.entries
            table = ContentTable()
    yield from table.entries


def grace(records: Iterable[Record], files, folder: str, table_bytes: int, fanout: int = FANOUT, level: int = 1) -> Iterator[list]:
    """Groups of equal content, whatever the number of records."""
    table, sinks, paths = ContentTable(), [], []

    def spill(record) -> None:
        content, top, ties, count = record
        # A hash of its own per level, else a bucket would not split any further.
        sink = sinks[xxhash.xxh3_64_intdigest(content, seed=level) % fanout]
        sink.write(struct.pack("<qqqI", top, ties, count, len(content)) + content)

    for record in records:
        if sinks:
            spill(record)
            continue
        table.add(record)
        # One content alone is a finished group, however long.
        if table.bytes > table_bytes and len(table.entries) > 1:
            own = join_path(folder, uuid.uuid4().hex)
            files.create_dir(own, recursive=True)
            paths = [join_path(own, str(i)) for i in range(fanout)]
            sinks = [files.open_output_stream(p, compression=None) for p in paths]
            for entry in table.entries:
                spill(entry)
            table = ContentTable()
    if not sinks:
        yield from table.entries
        return
    for sink in sinks:
        sink.close()

    def read(path: str) -> Iterator[Record]:
        size = struct.calcsize("<qqqI")
        with files.open_input_stream(path, compression=None, buffer_size=1 << 20) as source:
            while head := source.read(size):
                top, ties, count, length = struct.unpack("<qqqI", head)
                yield source.read(length), top, ties, count

    for path in paths:
        yield from grace(read(path), files, folder, table_bytes, fanout, level + 1)
        files.delete_file(path)
    files.delete_dir(own)


def _emit(entries: Iterator[list], row, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for entry in entries:
        rows.append(row(entry))
        held += len(entry[0]) + 100
        if held > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def groups(spark: SparkSession, docs: DataFrame, table_bytes: int = TABLE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """One row per distinct text: digest (SHA-256), top (largest id or NO_ID), ties, size."""
    importable(spark)
    folder = scratch_dir(spark, "grace")
    local = pa.schema([("content", pa.binary()), ("top", pa.int64()), ("ties", pa.int64()), ("size", pa.int64())])
    final = pa.schema([("digest", pa.binary()), ("top", pa.int64()), ("ties", pa.int64()), ("size", pa.int64())])

    def combine(batches):
        def records():
            for batch in batches:
                ids = batch.column(0).fill_null(NO_ID).to_pylist()
                for top, text in zip(ids, utf8(batch.column(1))):
                    yield normalised(text), top, 1, 1

        yield from _emit(merged_locally(records(), table_bytes), tuple, local)

    def finish(batches):
        files, root = open_folder(folder)

        def records():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        found = grace(records(), files, root, table_bytes, fanout)
        yield from _emit(found, lambda e: (hashlib.sha256(e[0]).digest(), *e[1:]), final)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    merged = rows.mapInArrow(tidy(combine), "content binary, top long, ties long, size long")
    return merged.repartition(F.xxhash64("content")).mapInArrow(tidy(finish), "digest binary, top long, ties long, size long")


def with_digest(docs: DataFrame, name: str) -> DataFrame:
    """All columns, and the SHA-256 of the normalised text."""
    place = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())])

    def digest(batches):
        for batch in batches:
            found = [hashlib.sha256(normalised(t)).digest() for t in utf8(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, name])

    return docs.mapInArrow(tidy(digest), schema)


def decided(spark: SparkSession, docs: DataFrame, table_bytes: int = TABLE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """`docs` with a struct column: digest, keep_id, size, kept; its name is the last column's."""
    rows = with_digest(docs, free_name(docs, "digest"))
    digest = rows.columns[-1]
    # Digests and numbers only; the texts were compared once, before this is written.
    found = stored(spark, groups(spark, docs, table_bytes, fanout), "exact-groups")
    any_tie = not found.filter("ties > 1").isEmpty()
    group = free_name(rows, "group")
    found = found.select(F.col("digest").alias(digest), F.struct("top", "ties", "size").alias(group))
    joined = join_grouped(rows, found, [digest], "inner")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    is_top = own == F.col(group)["top"]

    def decision(kept):
        keep_id = F.when(F.col(group)["top"] > NO_ID, F.col(group)["top"])
        return F.struct(F.col(digest).alias("digest"), keep_id.alias("keep_id"), F.col(group)["size"].alias("size"), kept.alias("kept")).alias(group)

    if not any_tie:
        return joined.select(*docs.columns, decision(is_top))
    # Rows that share text and largest id: only they are numbered.
    first = F.row_number().over(Window.partitionBy(digest).orderBy(F.lit(0))) == 1
    alone = joined.filter(~is_top | (F.col(group)["ties"] == 1))
    tied = joined.filter(is_top & (F.col(group)["ties"] > 1)).withColumn("_first", first)
    return alone.select(*docs.columns, decision(is_top)).unionAll(tied.select(*docs.columns, decision(F.col("_first"))))


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of `docs`."""
    rows = decided(spark, docs)
    return rows.filter(F.col(rows.columns[-1])["kept"]).select(*docs.columns)
