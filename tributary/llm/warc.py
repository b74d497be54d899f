"""WARC archives: one gzip member per record, written and read sequentially.

Writing: every task writes one archive at a time into the shared folder, under a name that
no other attempt uses, and returns its manifest row (path, records, bytes) as Spark output.
Only manifest rows of successful attempts are kept, so archives left by a lost executor are
never read. Reading: tasks take manifest rows and stream each archive in chunks; memory is
one chunk and one record.

Edge cases: a null payload is an empty one; equal payloads with equal largest ids give one
response, the other rows revisit it; a null id is smaller than any other and is written as
an empty header; an empty table gives no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.storage import importable, join_path, open_folder, stored
from tributary.operators.keyed import join_grouped
from tributary.session import scratch_dir

CHUNK = 1 << 16
# An archive is closed when it has this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, bytes long"
READ = (
    "record_id string, record_type string, target_uri string, page_id long, payload_bytes long, "
    "payload_digest string, refers_to long, payload binary"
)


def digest(payload: bytes) -> str:
    """Base32 SHA-1, as WARC headers carry it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items()), b"Content-Length: %d" % len(block)]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The record of a page: its payload as `response`, or a `revisit` without a block."""
    own = "" if page_id is None else str(page_id)
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{own}>",
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Payload-Length": str(len(payload)),
    }
    block = b"" if revisit else payload
    if revisit:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = f"<urn:page:{'' if refers_to is None else refers_to}>"
    headers["WARC-Block-Digest"] = f"sha1:{digest(block)}"
    return encode_record(headers, block)


class CorruptArchive(ValueError):
    """Framing or digest of an archive is wrong."""


def members(source) -> Iterator[Iterator[bytes]]:
    """Per gzip member the decompressed pieces, as they come from the file."""
    rest = b""

    def pieces() -> Iterator[bytes]:
        nonlocal rest
        unpacker = zlib.decompressobj(31)
        while True:
            if not rest:
                rest = source.read(CHUNK)
                if not rest:
                    raise CorruptArchive("archive ends within a gzip member")
            out = unpacker.decompress(rest, CHUNK)
            if unpacker.eof:
                rest = unpacker.unused_data
                yield out
                return
            rest = unpacker.unconsumed_tail
            yield out

    while True:
        if not rest:
            rest = source.read(CHUNK)
            if not rest:
                return
        yield pieces()


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record; framing and digests are verified."""
    for pieces in members(source):
        buffer = bytearray()
        head_end = -1
        need = None
        headers: dict[str, str] = {}
        for piece in pieces:
            buffer += piece
            if head_end < 0 and (head_end := buffer.find(b"\r\n\r\n", max(0, len(buffer) - len(piece) - 3))) >= 0:
                lines = bytes(buffer[:head_end]).split(b"\r\n")
                if lines[0] != VERSION:
                    raise CorruptArchive(f"not a record: {lines[0][:20]!r}")
                for line in lines[1:]:
                    key, _, value = line.decode().partition(":")
                    headers[key] = value.strip()
                need = head_end + 4 + int(headers["Content-Length"])
            if need is not None and len(buffer) > need + 4:
                raise CorruptArchive("member is longer than its Content-Length")
        if need is None or len(buffer) != need + 4 or buffer[need:] != b"\r\n\r\n":
            raise CorruptArchive("member does not end with its record")
        block = bytes(buffer[head_end + 4 : need])
        if headers.get("WARC-Block-Digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
            raise CorruptArchive(f"block digest of {headers.get('WARC-Record-ID')}")
        if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{digest(block)}":
            raise CorruptArchive(f"payload digest of {headers.get('WARC-Record-ID')}")
        yield headers, block


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload with `refers_to` and `revisit`.

    Payloads are compared by SHA-256 and length. The largest page_id of a payload is its
    response; a payload below `least_bytes` is always a response. The table of repeated
    payloads is reduced in the map tasks, the join may split a hot payload.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "utf-8"), F.lit(b"")).alias("payload"),
    ).withColumn("content", F.unhex(F.sha2("payload", 256)))
    # Null ids sort below all others; they count as the smallest long here.
    rank = F.coalesce("page_id", F.lit(-(1 << 63)))
    repeated = (
        rows.filter(F.length("payload") >= least_bytes)
        .groupBy("content", rank.alias("rank"))
        .agg(F.count(F.lit(1)).alias("same"))
        .groupBy("content")
        .agg(F.max(F.struct("rank", "same")).alias("top"), F.sum("same").alias("copies"))
        .filter("copies > 1")
        .select("content", "top")
    )
    # Numbers and digests only: small, read by the check below and by the join.
    repeated = stored(pages.sparkSession, repeated, "warc-repeated")
    joined = join_grouped(rows, repeated, ["content"])
    is_top = F.coalesce("page_id", F.lit(-(1 << 63))) == F.col("top.rank")
    refers = F.when(F.col("top.rank") > -(1 << 63), F.col("top.rank"))

    def typed(rows: DataFrame, revisit: Column) -> DataFrame:
        return rows.select("page_id", "url", "payload", F.when(revisit, refers).alias("refers_to"), F.coalesce(revisit, F.lit(False)).alias("revisit"))

    if repeated.filter("top.same > 1").isEmpty():
        return typed(joined, ~is_top)
    # Rows that share both payload and largest id: one of them stays the response.
    later = F.row_number().over(Window.partitionBy("content").orderBy("url")) > 1
    tied = joined.filter(is_top & (F.col("top.same") > 1)).withColumn("later", later)
    plain = joined.filter(F.col("top").isNull() | ~is_top | (F.col("top.same") == 1))
    return typed(plain, ~is_top).unionAll(typed(tied, F.col("later")))


def write_archives(spark: SparkSession, typed: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write `with_record_types` rows as archives below `folder`; returns the stored manifest."""

    def write(batches):
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        sink = path = None
        records = size = 0
        done = []

        def close():
            nonlocal sink
            if sink is not None:
                sink.close()
                done.append((path, records, size))
                sink = None

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")]
            for row in range(batch.num_rows):
                if sink is None:
                    path, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = files.open_output_stream(join_path(root, path), compression=None)
                data = page_record(*(c[row].as_py() for c in columns))
                sink.write(data)
                records += 1
                size += len(data)
                if size >= archive_bytes:
                    close()
        close()
        if done:
            names, counts, sizes = zip(*done)
            yield pa.record_batch({"path": pa.array(names), "records": pa.array(counts, pa.int64()), "bytes": pa.array(sizes, pa.int64())})

    importable(spark)
    return stored(spark, typed.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the archives in a manifest, one task at a time per archive."""

    def number(text: str | None) -> int | None:
        inner = (text or "").removeprefix("<urn:page:").removesuffix(">")
        return int(inner) if inner else None

    schema = pa.schema(
        [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("page_id", pa.int64()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def read(batches):
        files, root = open_folder(folder)
        rows, held = [], 0
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                seen = 0
                with files.open_input_stream(join_path(root, path), compression=None) as source:
                    for headers, block in read_records(source):
                        seen += 1
                        revisit = headers["WARC-Type"] == "revisit"
                        rows.append((
                            headers["WARC-Record-ID"], headers["WARC-Type"], headers["WARC-Target-URI"],
                            number(headers["WARC-Record-ID"]), int(headers["X-Payload-Length"]),
                            headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                            number(headers.get("WARC-Refers-To")), block if with_payload and not revisit else None,
                        ))
                        held += len(block) if with_payload else 100
                        if len(rows) >= 4096 or held > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if seen != records:
                    raise CorruptArchive(f"{path} has {seen} records instead of {records}")
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    importable(spark)
    # An archive is the unit of work; its name is random, so this deals them out evenly.
    return manifest.select("path", "records").repartition(max(1, manifest.count()), "path").mapInArrow(read, READ)


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write a record per page, read the archives back; columns of READ without the payload."""
    folder = scratch_dir(spark, "warc")
    manifest = write_archives(spark, with_record_types(pages, least_bytes), folder)
    return read_archives(spark, manifest, folder, with_payload=False).drop("payload")
