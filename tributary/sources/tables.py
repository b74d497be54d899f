"""Layer tables as Parquet folders, named in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tributary.schemas import LAYERS
from tributary.session import COMPRESSED


# Tables that streams write are partitioned by the number of the micro-batch.
BATCH = "batch_id"

# Files of an upstream table that a stream takes in per micro-batch.
FILES_PER_BATCH = 5_000


class Lake:
    """Folders `<root>/<layer>/<table>` with the streaming checkpoints beside them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root}/{layer}/{table}"

    def checkpoint(self, flow: str) -> str:
        return f"{self.root}/_checkpoints/{flow}"

    @property
    def event_log(self) -> str:
        return f"{self.root}/event_log"

    def _folder(self, path: str):
        """A folder and its file system."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def make(self, path: str) -> None:
        """See that a folder is there, so that it can be read as a stream before anything was written."""
        folder, system = self._folder(path)
        system.mkdirs(folder)

    def complete(self, path: str) -> bool:
        """Whether a write to this folder was committed."""
        folder, system = self._folder(f"{path}/_SUCCESS")
        return system.exists(folder)

    def numbers(self, path: str) -> list[int]:
        """The numbers of the complete folders `<name>=<number>` below a folder, in ascending order."""
        folder, system = self._folder(path)
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(int(n.split("=")[1]) for n in names if "=" in n and self.complete(f"{path}/{n}"))

    def remove(self, path: str) -> None:
        folder, system = self._folder(path)
        system.delete(folder, True)

    def read(self, layer: str, table: str) -> DataFrame:
        """Snapshot of a table, without the numbers of the batches that wrote it."""
        return self.spark.read.parquet(self.path(layer, table)).drop(BATCH)

    def stream(self, layer: str, table: str, schema: StructType, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
        """New rows of an append-only table; a backlog is worked off in several batches."""
        reader = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(self.path(layer, table))

    def materialize(self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None) -> DataFrame:
        """Recompute a derived table and return it as read from storage.

        Rows of a partitioned table are brought together per partition first, to
        write few files; a partition that holds a great share of them is split.
        """
        if partition_by:
            writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
        else:
            writer = df.write.mode("overwrite")
        writer.options(**COMPRESSED).parquet(self.path(layer, table))
        return self.read(layer, table)

    def _database(self, layer: str, prefix: str) -> str:
        database = f"{prefix}{layer}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/_databases/{database}'")
        return database

    def publish(self, layer: str, table: str, comment: str, prefix: str = "") -> str:
        """Name a stored table `layer.table` with a comment and its quality level."""
        name = f"{self._database(layer, prefix)}.{table}"
        text = comment.replace("'", "''")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(
            f"CREATE TABLE {name} USING parquet LOCATION '{self.path(layer, table)}' COMMENT '{text}' "
            f"TBLPROPERTIES ('quality' = '{layer}')"
        )
        if any(column.isPartition for column in self.spark.catalog.listColumns(name)):
            self.spark.catalog.recoverPartitions(name)
        return name

    def publish_view(self, layer: str, view: str, query: str, prefix: str = "") -> str:
        """Keep a SQL query over published tables as the view `layer.view`."""
        name = f"{self._database(layer, prefix)}.{view}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
        return name
