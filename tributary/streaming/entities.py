"""Silver entity tables: current state kept from a change stream.

A micro-batch adds one delta partition with the newest row per key of that batch, so it
costs what it holds. `compact` merges the deltas into a keyed table, where only the buckets
of changed keys are written again, and removes what the last versions do not name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.keyed import latest_per_key
from tributary.plans import silver
from tributary.schemas import INGESTED_AT, SOURCE_FILE
from tributary.session import COMPRESSED
from tributary.sources.keyed_table import BUCKETS, KEPT_VERSIONS, KeyedTable
from tributary.sources.tables import BATCH, Lake
from tributary.streaming import bronze


class CurrentState:
    """Newest row per key of a stream of changes, stored below one folder."""

    def __init__(self, lake: Lake, path: str, keys: list[str], sequence: str, ties: list[str], buckets: int = BUCKETS):
        self.path = path
        self.table = KeyedTable(lake.spark, path, keys, sequence, ties, buckets)

    def apply(self, df: DataFrame, batch: int) -> None:
        """Store one micro-batch; repeating it replaces it."""
        newest = latest_per_key(df, self.table.keys, self.table.sequence, self.table.ties)
        newest.write.mode("overwrite").options(**COMPRESSED).parquet(f"{self.path}/delta/{BATCH}={batch}")

    def _pending(self) -> tuple[int, DataFrame | None]:
        """The last complete delta and the rows of all that no version holds yet."""
        known, deltas = self.table.manifest(), self.table.numbered("delta")
        through = known.version if known else -1
        paths = [p for n, p in sorted(deltas.items()) if n > through]
        rows = self.table.spark.read
        if known:
            rows = rows.schema(known.schema)
        return max(deltas, default=-1), rows.parquet(*paths) if paths else None

    def current(self) -> DataFrame:
        """One row per key: the newest version and the deltas after it."""
        return self.table.read(self._pending()[1])

    def compact(self, keep: int = KEPT_VERSIONS) -> None:
        """Merge all complete deltas into a new version; keep the files of the last `keep` versions."""
        through, rows = self._pending()
        if rows is not None:
            self.table.merge(rows, through)
        oldest = self.table.remove_old(keep)
        for number, path in self.table.numbered("delta").items():
            if number <= oldest:
                self.table.remove(path)


# Entity table: key and cleaning step.
ENTITY_FLOWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "freelancers": ("visitor_id", silver.clean_freelancers),
    "clients": ("client_uid", silver.clean_clients),
    "job_openings": ("opening_uid", silver.clean_jobs),
}


def state(lake: Lake, name: str) -> CurrentState:
    """The stored state of an entity table.

    Rows of one micro-batch share their ingestion time, so the file name and then
    the remaining columns decide between them.
    """
    key, clean = ENTITY_FLOWS[name]
    columns = clean(lake.spark.createDataFrame([], bronze.bronze_schema(name))).columns
    rest = [c for c in columns if c not in (key, INGESTED_AT, SOURCE_FILE, "processed_at")]
    return CurrentState(lake, lake.path("silver", f"{name}_changes"), [key], INGESTED_AT, [SOURCE_FILE, *rest])


def start_changes(target: CurrentState, changes: DataFrame, checkpoint: str) -> StreamingQuery:
    """Feed a change stream into a stored state."""
    return (
        changes.writeStream.foreachBatch(target.apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start(lake: Lake, name: str) -> StreamingQuery:
    _, clean = ENTITY_FLOWS[name]
    changes = clean(bronze.new_rows(lake, name))
    return start_changes(state(lake, name), changes, lake.checkpoint(f"silver_{name}"))
