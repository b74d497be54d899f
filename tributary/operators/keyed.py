"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unused_name(wish: str, *frames: DataFrame) -> str:
    """`wish`, with underscores in front until none of the tables has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order; all columns kept.

    `row_number() = 1` is planned with a partial group limit before the shuffle,
    so a hot key sends one row per map task, not all of its rows.
    """
    rank = unused_name("_rank", df)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank) == 1).drop(rank)


def latest_per_key(df: DataFrame, keys: list[str], sequence: str, ties: list[str] | None = None) -> DataFrame:
    """Current state of a change feed: the row with the highest sequence per key.

    Rows of equal sequence are ordered by `ties`, by default all other columns,
    so the result does not depend on the order of arrival.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != sequence]
    order = [F.col(c).desc_nulls_last() for c in [sequence, *ties]]
    return first_per_key(df, keys, order)


def join_grouped(rows: DataFrame, grouped: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join rows to a table that was grouped by the same keys, ready for hot keys.

    AQE splits a hot partition only when both inputs of the join come straight
    from a shuffle. A table grouped by the join keys is not shuffled again, so
    its partner's hot key would stay in one task. The hash as a further join key
    gives the (small) grouped table a shuffle of its own.
    """
    spread, name = F.xxhash64(*keys), unused_name("_spread", rows, grouped)
    joined = rows.withColumn(name, spread).join(grouped.withColumn(name, spread), [*keys, name], how)
    return joined.drop(name)
