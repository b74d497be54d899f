"""A table with one row per key that is updated by copy on write.

Keys are dealt to a fixed number of buckets by their hash. A version of the table is a manifest: for every
bucket the version whose files hold it. An update reads and writes the buckets of its keys alone and names the
others' files again; it counts once its manifest is complete, so a crash before that changes nothing.
One writer at a time; readers may go on with any of the last manifests. Rows must not have a column `_part`.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.operators.keyed import latest_per_key
from tributary.session import COMPRESSED

# Buckets of a new table. A table keeps the number it was made with.
BUCKETS = 64
# Manifests whose files stay readable after an update.
KEPT_VERSIONS = 3

_BUCKET = "_part"
_MANIFEST = "buckets int, columns string, files map<int, bigint>"


@dataclass
class Manifest:
    """A version of the table: the schema as JSON, and per bucket the version that wrote its files."""

    version: int
    buckets: int
    columns: str
    files: dict[int, int] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.columns))


class KeyedTable:
    """Newest row per key below a folder; `ties` decide between rows of equal sequence."""

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], sequence: str, ties: list[str] | None = None, buckets: int = BUCKETS
    ):
        self.spark = spark
        self.path = path
        self.keys = keys
        self.sequence = sequence
        self.ties = ties
        self.buckets = buckets

    # folders

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def numbered(self, kind: str, complete: bool = True) -> dict[int, str]:
        """Folders `<kind>/<name>=<number>`; by default only those whose write was committed."""
        root, system = self._folder(f"{self.path}/{kind}")
        if not system.exists(root):
            return {}
        found = {}
        for status in system.listStatus(root):
            path = status.getPath()
            done = self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
            if "=" in path.getName() and (not complete or system.exists(done)):
                found[int(path.getName().split("=")[1])] = path.toString()
        return found

    def remove(self, path: str) -> None:
        folder, system = self._folder(path)
        system.delete(folder, True)

    # versions

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A version's manifest, by default the newest; None if nothing was committed."""
        known = self.numbered("manifest")
        if version is None:
            version = max(known, default=None)
        if version is None:
            return None
        row = self.spark.read.schema(_MANIFEST).parquet(known[version]).first()
        return Manifest(version, row["buckets"], row["columns"], dict(row["files"]))

    def _files(self, version: int, bucket: int) -> str:
        return f"{self.path}/files/version={version}/{_BUCKET}={bucket}"

    def _read(self, known: Manifest, buckets: list[int]) -> DataFrame:
        paths = [self._files(known.files[b], b) for b in sorted(buckets)]
        if not paths:
            return self.spark.createDataFrame([], known.schema)
        return self.spark.read.schema(known.schema).parquet(*paths)

    def _bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(count)).cast("int")

    def _touched(self, changes: DataFrame, count: int) -> list[int]:
        """The buckets of the changed keys: at most as many numbers as there are buckets."""
        return [r[0] for r in changes.select(self._bucket(count).alias("b")).distinct().collect()]

    def _merged(self, changes: DataFrame, known: Manifest | None, touched: list[int], count: int) -> DataFrame:
        """Newest row per key of the touched buckets, brought together by bucket in one shuffle."""
        rows = changes
        if known:
            rows = rows.unionByName(self._read(known, [b for b in touched if b in known.files]))
        dealt = rows.withColumn(_BUCKET, self._bucket(count)).repartition(max(1, len(touched)), _BUCKET)
        ties = self.ties if self.ties is not None else [c for c in changes.columns if c not in (*self.keys, self.sequence)]
        return latest_per_key(dealt, [_BUCKET, *self.keys], self.sequence, ties)

    def merge(self, changes: DataFrame, version: int) -> Manifest:
        """Fold changes into the buckets of their keys and commit the result as a new version."""
        known = self.manifest()
        if known and version <= known.version:
            raise ValueError(f"version {version} does not follow {known.version}")
        count = known.buckets if known else self.buckets
        touched = self._touched(changes, count)
        if touched:
            merged = self._merged(changes, known, touched, count)
            merged.write.mode("overwrite").options(**COMPRESSED).partitionBy(_BUCKET).parquet(f"{self.path}/files/version={version}")
        files = {**(known.files if known else {}), **{b: version for b in touched}}
        columns = known.columns if known else changes.schema.json()
        row = self.spark.createDataFrame([(count, columns, files)], _MANIFEST)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        return Manifest(version, count, columns, files)

    def read(self, changes: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version, with changes not merged yet on top.

        Buckets without a change are read as they are; only the others are shuffled.
        """
        known = self.manifest(version)
        if known is None and changes is None:
            raise ValueError(f"no change was stored below {self.path}")
        if changes is None:
            return self._read(known, list(known.files))
        if known is None:
            return latest_per_key(changes, self.keys, self.sequence, self.ties)
        touched = self._touched(changes, known.buckets)
        parts = [self._read(known, [b for b in known.files if b not in touched])]
        if touched:
            parts.append(self._merged(changes, known, touched, known.buckets).drop(_BUCKET))
        return reduce(DataFrame.unionByName, parts)

    def remove_old(self, keep: int = KEPT_VERSIONS) -> int:
        """Remove manifests before the last `keep` and files that no kept one names; returns the oldest version kept.

        Manifests go first, so that nobody opens one whose files are gone. Files of an update that never
        committed go as well.
        """
        versions = sorted(self.numbered("manifest"), reverse=True)
        kept = versions[: max(1, keep)]
        if not kept:
            return -1
        named = {(v, b) for k in kept for b, v in self.manifest(k).files.items()}
        for version, path in self.numbered("manifest", complete=False).items():
            if version not in kept:
                self.remove(path)
        for version, path in self.numbered("files", complete=False).items():
            if not any(v == version for v, _ in named):
                self.remove(path)
                continue
            for bucket, part in self.numbered(f"files/version={version}", complete=False).items():
                if (version, bucket) not in named:
                    self.remove(part)
        return kept[-1]
