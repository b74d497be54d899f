"""Tables, files and names shared by the operators."""

from __future__ import annotations

import ctypes
import posixpath
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_dir


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read from there.

    Cuts the lineage at a point that outlives every executor; columns that are not
    deterministic (row numbers of a task) are fixed by it.
    """
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """`wish`, with underscores in front until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder, usable on driver and executors.

    A folder without a scheme is a local path, as Spark takes it in a local session.
    """
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    # Hadoop's names of S3 are not those of Arrow.
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def join_path(*parts: str) -> str:
    return posixpath.join(*parts)


def thinned(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """About four times `size` rows, those of the smallest hashes of `by`; all rows if there are fewer.

    To be cut to `size` by that hash (`spread`): so each task holds few rows for it, however many
    tasks there are.
    """
    share = 4 * size / max(1, rows.count())
    return rows if share >= 1 else rows.filter(F.pmod(F.xxhash64(*by), F.lit(1 << 31)) < int(share * (1 << 31)))


def spread(by: list[str]) -> list[Column]:
    """The order in which `thinned` rows are cut to size."""
    return [F.pmod(F.xxhash64(*by), F.lit(1 << 31)), *(F.col(c) for c in by)]


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


# What this worker keeps between tasks: by operator, how to drop it.
_drops: dict[str, Callable[[], None]] = {}


def keeping(name: str, drop: Callable[[], None]) -> None:
    """Say that the operator `name` keeps something in this worker between its tasks."""
    _drops[name] = drop


def begin_task(keeps: str | None) -> None:
    for name in [n for n in _drops if n != keeps]:
        _drops.pop(name)()


# Gives the C library's free memory back to the machine; only glibc has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def end_task() -> None:
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidy(work: Callable, keeps: str | None = None) -> Callable:
    """`work` for `mapInArrow`, by which a worker holds one operator's cache at a time.

    Workers outlive stages: at the start what operators other than `keeps` kept is dropped, at the end
    the free memory of Arrow and of the C library goes back to the machine.
    """

    def run(batches):
        begin_task(keeps)
        try:
            yield from work(batches)
        finally:
            end_task()

    return run


def summed(rows: DataFrame, size: int, part: Callable[[pa.RecordBatch], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of `part`, an array of `size` numbers, over all batches of `rows`; each task sends one such array."""

    def parts(batches) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(batch)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    sums = rows.mapInArrow(parts, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(size, np.int64 if kind == "long" else float)
    for row in sums.collect():
        out[row["place"]] = row["value"]
    return out


# What a Python worker is handed at once: it holds a batch several times over.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when the driver found it by `sys.path` alone.

    Also bounds the batches that go to them.
    """
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    root = posixpath.dirname(posixpath.dirname(posixpath.dirname(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])
    return spark
