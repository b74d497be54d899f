"""Exact quantiles per group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.rollup import tally

# Bands for each factor of e between values. More bands: fewer values in each, longer lists of bands.
BANDS = 4096


def band_of(value: Column) -> Column:
    """The number of a value's band: bands rise with values, and one spans 0.02 % of a value (below 1: 0.0002).

    Not a number is in the band of the largest values; in a band, rows are in Spark's order of values.
    """
    number = value.cast("double")
    return F.when(F.isnan(number), F.lit(2**63 - 1)).otherwise(F.floor(F.signum(number) * F.log1p(F.abs(number)) * BANDS))


def weighted_quantiles(df: DataFrame, by: str, value: str, weight: Column, probabilities: list[float], name: str) -> DataFrame:
    """Interpolated quantiles of `value` repeated `weight` times, as an array.

    `df` is read twice; pass a stored table or one whose last shuffle is reused. Equal values are added up
    before a shuffle, so a hot group is spread over its values. Values fall into bands by a fixed rule. The weights of
    a group's bands, added up in order, tell in which of them each wanted rank lies; the second reading looks
    into those bands alone and adds up their values in order. No group is ever in one task: only its
    list of bands, whose length the range of values bounds, and the few bands that hold a rank.
    """
    counts = tally(df.filter(F.col(value).isNotNull()), [by, value], _weight=F.sum(weight)).filter("_weight > 0")
    counts = counts.withColumn("_band", band_of(F.col(value)))
    group = Window.partitionBy(by)
    ranked = tally(counts, [by, "_band"], _sum=F.sum("_weight")).withColumns(
        {"_before": F.sum("_sum").over(group.orderBy("_band")) - F.col("_sum"), "_total": F.sum("_sum").over(group)}
    )

    def ranks(p: float) -> tuple[Column, Column]:
        exact = F.lit(p) * (F.col("_total") - 1)
        return F.floor(exact), F.ceil(exact)

    def holds(rank: Column, size: str) -> Column:
        return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col(size))

    wanted = F.lit(False)
    for p in probabilities:
        for rank in ranks(p):
            wanted = wanted | holds(rank, "_sum")
    chosen = ranked.filter(wanted).select(F.col(by).alias("_group"), F.col("_band").alias("_chosen"), "_before", "_total")

    same = F.col(by).eqNullSafe(F.col("_group")) & (F.col("_band") == F.col("_chosen"))
    # One shuffle by group serves the sums in a band and the last step.
    rows = counts.join(chosen, same).drop("_group", "_chosen").repartition(by)
    within = Window.partitionBy(by, "_band").orderBy(value)
    rows = rows.withColumn("_before", F.col("_before") + F.sum("_weight").over(within) - F.col("_weight"))
    picked = {}
    for i, p in enumerate(probabilities):
        low, high = ranks(p)
        picked[f"_low{i}"] = F.max(F.when(holds(low, "_weight"), F.col(value)))
        picked[f"_high{i}"] = F.max(F.when(holds(high, "_weight"), F.col(value)))
    found = tally(rows, by, _total=F.max("_total"), **picked)

    def between(i: int, p: float) -> Column:
        exact = F.lit(p) * (F.col("_total") - 1)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return low + (exact - F.floor(exact)) * (high - low)

    return found.select(by, F.array(*[between(i, p) for i, p in enumerate(probabilities)]).alias(name))
