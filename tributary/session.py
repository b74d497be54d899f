"""Session settings and shared scratch space."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every run relies on. Joins are left to the planner: a side is
# broadcast only when its measured size is below autoBroadcastJoinThreshold,
# and AQE splits hot partitions of the larger side of a sort-merge join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows in a task's sorts and hash tables take ten times the bytes and more of a shuffle: small
    # partitions keep them in memory, so nothing is spilled.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
    # As many small files to a task as Spark's defaults give it.
    "spark.sql.files.openCostInBytes": "512k",
    # A table by days has thousands of folders: they are listed by a few tasks, not by a task each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # State that grows with the stream (keys seen so far) stays on disk.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tributary", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` uses `__` for dots in keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Every layer is written and read again: half the bytes of the default codec for little time. An option
# of our own writers, so that what others write in the session is as they set it.
COMPRESSED = {"compression": "zstd"}

# What a query shuffled goes when it ends, not when the driver happens to collect its garbage.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# While layers are built from layers: rows take far more than the bytes of their zstd files, by which Spark
# judges what it may send through the driver.
BUILDING = {"spark.sql.sources.fileCompressionFactor": "32", **CLEANED}

_STATIC, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"

PARTITION_MB = 16


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """`values` for what is run inside, streams that are started there included."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def joining_events(spark: SparkSession) -> dict[str, str]:
    """`BUILDING` for joins of event tables alone: what they shuffled is measured, and only then may a side be broadcast."""
    return {**BUILDING, _STATIC: "-1", _MEASURED: spark.conf.get(_STATIC)}


def expect_shuffles_of(spark: SparkSession, gigabytes: float) -> SparkSession:
    """Cut shuffles finely enough for the largest one: about 16 MB for each partition.

    AQE joins partitions that turn out small; it cannot cut those that too small a number
    makes too large, other than of skewed joins. A number that is large enough stays as it is.
    """
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = math.ceil(gigabytes * 1024 / PARTITION_MB)
    if wanted > int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(initial, str(wanted))
    return spark


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once to the shared scratch folder and read from there: for results that are needed several times."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.options(**COMPRESSED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder in the shared checkpoint location.

    The location is the one the cluster names in `spark.checkpoint.dir`. Only a
    local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tributary/{purpose}-{uuid.uuid4().hex}"
