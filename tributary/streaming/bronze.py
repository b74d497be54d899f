"""Bronze: append every new landing file to a table, each exactly once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType, TimestampType

from tributary.schemas import INGESTED_AT, RAW, RESCUED, SOURCE_FILE
from tributary.session import COMPRESSED
from tributary.sources.landing import FILES_PER_BATCH, converted, headers_of, infer_schema, stream_lines
from tributary.sources.tables import BATCH, Lake
from tributary.sources.tables import FILES_PER_BATCH as TABLE_FILES


def bronze_schema(name: str) -> StructType:
    return (
        StructType(list(RAW[name].fields))
        .add(RESCUED, StringType())
        .add(SOURCE_FILE, StringType())
        .add(INGESTED_AT, TimestampType())
    )


def _stored(lake: Lake, path: str, schema: str) -> DataFrame:
    """A small table of the lake, made without rows when it is asked for first."""
    lake.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return lake.spark.read.schema(schema).parquet(path)


def kept_schema(lake: Lake, name: str, root: str | None = None, files: str = "*") -> StructType:
    """The schema inferred from the first files of a dataset, the same in every later run."""
    folder = lake.checkpoint(f"schema_{name}")
    known = _stored(lake, folder, "schema string").first()
    if known:
        return StructType.fromJson(json.loads(known["schema"]))
    schema = infer_schema(lake.spark, name, root, files)
    lake.spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("append").parquet(folder)
    return schema


def start(
    lake: Lake,
    name: str,
    root: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    schema: StructType | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start taking in the files that are new since the last run; with `every` go on and look again so often.

    A micro-batch stores the headers of its files, then its rows, each in a partition of its number. A batch that was
    committed is not written again when the stream repeats it, so readers of the table see its files once.
    """

    def store(lines: DataFrame, batch: int) -> None:
        rows, headers = f"{lake.path('bronze', name)}/{BATCH}={batch}", f"{lake.checkpoint(f'headers_{name}')}/{BATCH}={batch}"
        if lake.complete(rows):
            return
        headers_of(lines).write.mode("overwrite").options(**COMPRESSED).parquet(headers)
        found = lines.sparkSession.read.parquet(headers)
        converted(lines, found, schema or RAW[name]).write.mode("overwrite").options(**COMPRESSED).parquet(rows)

    lake.make(lake.path("bronze", name))
    stream = (
        stream_lines(lake.spark, name, root, files_per_batch)
        .writeStream.foreachBatch(store)
        .queryName(f"bronze_{name}_{id(lake)}")
        .option("checkpointLocation", lake.checkpoint(f"bronze_{name}"))
    )
    return (stream.trigger(processingTime=every) if every else stream.trigger(availableNow=True)).start()


def ingest(lake: Lake, names: list[str], root: str | None = None, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Take in all new files of some datasets; the streams run side by side."""
    for query in [start(lake, name, root, files_per_batch) for name in names]:
        query.awaitTermination()


def new_rows(lake: Lake, name: str, files_per_batch: int = TABLE_FILES) -> DataFrame:
    """A bronze table as a stream."""
    return lake.stream("bronze", name, bronze_schema(name), files_per_batch).drop(BATCH)
