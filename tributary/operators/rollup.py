"""Grouped counts that survive hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalars import percent
from tributary.operators.keyed import unused_name


def tally(df: DataFrame, by: str | Column | list[str], **measures: Column) -> DataFrame:
    """Aggregate with named measures: `tally(df, "day", clicks=F.count("id"))`; without measures the distinct keys."""
    keys = by if isinstance(by, list) else [by]
    if not measures:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def with_ctr(shown: DataFrame, clicked: DataFrame, key: str) -> DataFrame:
    """Join clicks to impressions on the group key; a group without clicks keeps NULL.

    A plain `=` join: the group whose key is NULL finds no partner.
    """
    joined = shown.join(clicked, key, "left")
    return joined.withColumn("ctr_pct", percent(F.col("clicks"), F.col("impressions")))


def same_key(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on a key where NULL equals NULL; the key is kept once."""
    name = unused_name("_other_key", left, right)
    other = right.withColumnRenamed(key, name)
    return left.join(other, F.col(key).eqNullSafe(F.col(name)), how).drop(name)
