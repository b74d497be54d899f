"""Silver event tables: validated micro-batches and their quality log.

Every micro-batch is written to its own partition, named by the batch number, and
so is its log record. A batch that is repeated after a crash replaces what it
wrote before, so rows and counts are kept exactly once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.event_log import progress_record
from tributary.operators.expectations import Rule, enforce
from tributary.plans import silver
from tributary.session import COMPRESSED
from tributary.sources.tables import BATCH, Lake
from tributary.streaming import bronze

LOG_SCHEMA = (
    "timestamp timestamp, event_type string, origin struct<flow_name:string>, details string, "
    "flow string, batch_id bigint"
)

# Silver table: how bronze rows are typed, and the rules.
EVENT_FLOWS: dict[str, tuple[Callable[[DataFrame], DataFrame], list[Rule]]] = {
    "search_events": (lambda raw: raw, silver.SEARCH_RULES),
    "impression_events": (silver.typed_impressions, silver.IMPRESSION_RULES),
    "click_events": (silver.typed_clicks, silver.CLICK_RULES),
}


def write_log(lake: Lake, flow: str, batch: int, rules: list[Rule], counts: dict[str, int]) -> None:
    """Store the log record of one batch of a flow."""
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    row = lake.spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])
    record = row.select(F.lit(now).cast("timestamp").alias("timestamp"), *progress_record(flow, rules))
    record.coalesce(1).write.mode("overwrite").parquet(f"{lake.event_log}/flow={flow}/{BATCH}={batch}")


def read_log(lake: Lake) -> DataFrame:
    return lake.spark.read.schema(LOG_SCHEMA).parquet(lake.event_log).drop("flow", BATCH)


def store_checked(lake: Lake, df: DataFrame, layer: str, table: str, rules: list[Rule], batch: int) -> None:
    """Write the accepted rows of one batch and log the outcome of the rules."""
    seen = Observation()
    rows = enforce(df, rules, seen)
    rows.write.mode("overwrite").options(**COMPRESSED).parquet(f"{lake.path(layer, table)}/{BATCH}={batch}")
    write_log(lake, f"{layer}.{table}", batch, rules, seen.get)


def start(lake: Lake, name: str) -> StreamingQuery:
    """Validate the bronze rows that are new since the last run."""
    typed, rules = EVENT_FLOWS[name]

    def store(df: DataFrame, batch: int) -> None:
        store_checked(lake, typed(df), "silver", name, rules, batch)

    return (
        bronze.new_rows(lake, name)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", lake.checkpoint(f"silver_{name}"))
        .trigger(availableNow=True)
        .start()
    )


def start_quarantine(lake: Lake) -> StreamingQuery:
    """Keep the bot impressions in their own append-only table."""
    return (
        silver.quarantine_impressions(bronze.new_rows(lake, "impression_events"))
        .writeStream.format("parquet")
        .options(**COMPRESSED)
        .option("checkpointLocation", lake.checkpoint("quarantine_impression_events"))
        .trigger(availableNow=True)
        .start(lake.path("silver", "quarantine_impression_events"))
    )


def read_events(lake: Lake, name: str) -> DataFrame:
    """A silver event table."""
    return lake.read("silver", name)


def without_repeats(events: DataFrame, key: str) -> DataFrame:
    """Drop repeated deliveries of an event in a stream, however far apart they arrive.

    Every key that was seen is remembered, so the result does not depend on how files are
    dealt to batches. The keys lie in the session's state store, spread over its partitions;
    the RocksDB store of `SETTINGS` keeps them on disk and not in the executors' heap.
    """
    return events.dropDuplicates([key])
