"""Connected components of an undirected graph, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tributary.llm.storage import stored, tidy
from tributary.operators.keyed import join_grouped

# Nodes that a task holds while it shortens its own edges.
MOST_NODES = 500_000


def shortened(edges: DataFrame, most_nodes: int = MOST_NODES) -> DataFrame:
    """Each task's edges as stars around the smallest nodes; connects what `edges` connect.

    No shuffle: whatever edges a task holds are merged, as many as fit, and then the next.
    """

    def merge(batches) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            while (up := parent.setdefault(node, node)) != node:
                parent[node] = node = parent[up]
            return node

        def stars() -> pa.RecordBatch:
            rows = [(node, root(node)) for node in list(parent)]
            rows = [r for r in rows if r[0] != r[1]]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            for a, b in zip(*(batch.column(c).to_pylist() for c in ("u", "v"))):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) >= most_nodes:
                yield stars()
        if parent:
            yield stars()

    return edges.select("u", "v").mapInArrow(tidy(merge), "u long, v long")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of `edges` (a, b: long).

    A large star links a node's larger neighbours to its smallest one, a small star its smaller
    ones; both keep components and shorten paths, until every component is a star around
    its root. Neighbours are never collected: the smallest one is an aggregate that is joined
    back, and the join may split a node with very many neighbours. Rounds grow with the
    logarithm of the number of nodes.
    """

    def kept(rows: DataFrame) -> tuple[DataFrame, tuple]:
        """The distinct edges, stored, and what tells them from others."""
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", "u")).alias("y")]
        table = stored(spark, rows.filter("u <> v").distinct().observe(seen, *measures), "edges")
        found = seen.get
        return table, (found["n"], found["x"], found["y"])

    # From here on every edge points from the larger to the smaller node.
    directed = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current, mark = kept(shortened(directed))
    while mark[0]:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = join_grouped(both, least, ["u"], "inner").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = join_grouped(large, least, ["u"], "inner")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        before = mark
        current, mark = kept(shortened(small))
        if mark == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
