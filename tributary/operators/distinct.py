"""Exact distinct counts that add up: bitmaps of coded ids per group.

A count of distinct ids cannot be added over days; a bitmap of them can be merged. Ids get numbers once (a dictionary),
a group keeps one bitmap of 32,768 bits per range of numbers, and any coarser group is the union of bitmaps:
no event and no id is read again for it. Groups with a handful of ids are better counted directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.keyed import join_grouped
from tributary.operators.rollup import tally

BUCKET, BITMAP = "bucket", "bitmap"


def numbered(ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """kind, id, code of the distinct ids of each kind, NULLs left out; store it, as codes are given by task and place.

    Each task numbers its ids one after the other, a kind at a time, so bitmaps are densely set. Ids that `known` holds
    keep their codes; new ones come after all of them.
    """
    rows = ids.filter("id IS NOT NULL").select("kind", "id").distinct()
    first = F.lit(1).cast("long")
    if known is not None:
        rows = rows.join(known.select("kind", "id"), ["kind", "id"], "left_anti")
        first = F.lit((known.agg(F.max("code")).first()[0] or 0) + 1)
    rows = rows.sortWithinPartitions("kind", "id").withColumn("code", F.monotonically_increasing_id() + first)
    return rows if known is None else known.select("kind", "id", "code").unionAll(rows)


def states(rows: DataFrame, by: list[str], codes: DataFrame) -> DataFrame:
    """by, kind, bucket, bitmap: the distinct ids of each group. `rows` holds by, kind and id."""
    each = rows.filter("id IS NOT NULL").select(*by, "kind", "id").distinct()
    coded = join_grouped(each, codes, ["kind", "id"], "inner").withColumn(BUCKET, F.bitmap_bucket_number("code"))
    return tally(coded, [*by, "kind", BUCKET], bitmap=F.bitmap_construct_agg(F.bitmap_bit_position("code")))


def merged(found: DataFrame, by: list[Column | str]) -> DataFrame:
    """States of coarser groups; `by` are columns of the finer ones or made from them."""
    return found.groupBy(*by, "kind", BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def counted(found: DataFrame, by: list[str], kinds: dict[str, str]) -> DataFrame:
    """by, and for each kind its number of distinct ids under the name given; 0 where a group has none of a kind."""
    ones = F.bitmap_count(BITMAP)
    sums = {name: F.coalesce(F.sum(F.when(F.col("kind") == kind, ones)), F.lit(0)) for kind, name in kinds.items()}
    return tally(found, by, **sums)
