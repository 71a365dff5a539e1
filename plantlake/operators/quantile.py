"""Exact medians of large groups."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.session import checkpoint

#: Rank error of the sketch that cut points are taken from.
ACCURACY = 10_000
#: The part of a group on either side of its middle that is cut densest at first.
MARGIN = 0.001
#: Equal parts in which the rest is cut again, by rank and by value.
PARTS = 16


def exact_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median of `value` per group as a double, NULL values left out; a NULL key is a group.

    Selection by histograms that are refined. A mergeable sketch of fixed size gives cut points of each group; values are
    counted between and on them, before anything is shuffled, and the counts show the bin of either middle rank. Ranks in
    two bins are the largest value of one and the smallest of the next, and a bin of one value is known. Only the values of a
    bin that holds both ranks, a few in ten thousand, are cut again, by rank and by value, until none is left. A cut point is a
    bin of its own, and some are values of the group, so every round ends with fewer values; even a poor sketch leaves a
    sixteenth of the range. No values are sorted, and none meet in one task.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    total = F.count(F.lit(1))
    cut = rows.groupBy(*_named(keys)).agg(
        F.percentile_approx("_v", _near(), ACCURACY).alias("_cuts"),
        F.floor((total + 1) / 2).alias("_low"),
        F.floor((total + 2) / 2).alias("_high"),
    )
    medians, n_cuts = None, len(_near())
    while True:
        picked = checkpoint(_picked(rows, cut, keys, n_cuts))
        found = picked.where("_least IS NULL").select(*keys, "median")
        medians = found if medians is None else medians.unionByName(found)
        left = picked.where("_least IS NOT NULL")
        if left.isEmpty():
            return medians
        left = left.select(*_named(keys), "_low", "_high", "_least", "_most")
        inside = rows.join(left, _same(keys)).where(F.col("_v").between(F.col("_least"), F.col("_most")))
        rows = checkpoint(inside.select(*keys, "_v"))
        shares = [k / PARTS for k in range(PARTS + 1)]
        cuts = rows.groupBy(*keys).agg(F.percentile_approx("_v", shares, ACCURACY).alias("_at"))
        by_value = [F.col("_least") * (1 - s) + F.col("_most") * s for s in shares[1:-1]]
        both = F.concat("_at", F.array(*by_value)).alias("_cuts")
        cut = left.join(cuts, _same(keys)).select(*[f"_k_{k}" for k in keys], both, "_low", "_high")
        n_cuts = len(shares) + len(by_value)


def _near() -> list[float]:
    """Shares of a group at which it is first cut, dense around the middle."""
    beside = sorted({min(0.5, MARGIN * k) for k in (0.2, 0.5, 1, 3, 10)} | {0.05, 0.25, 0.5})
    return [0.5 - b for b in reversed(beside)] + [0.5] + [0.5 + b for b in beside]


def _named(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"_k_{k}") for k in keys]


def _same(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])


def _picked(rows: DataFrame, cut: DataFrame, keys: list[str], n_cuts: int) -> DataFrame:
    """Per group the median, or the bounds of the bin that holds both middle ranks and the ranks within it."""
    cuts = [F.get("_cuts", F.lit(k)) for k in range(n_cuts)]
    # Even numbers lie between cut points, odd ones on them.
    place = sum(((F.col("_v") > c).cast("int") + (F.col("_v") >= c).cast("int") for c in cuts), F.lit(0))
    bins = (
        rows.join(cut, _same(keys))
        .groupBy(*keys, "_low", "_high", place.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    )
    # A group has at most twice as many bins as cut points, and one.
    ranked = bins.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin")))

    def at(rank: str, what: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_n") < F.col(rank)), what))

    found = ranked.groupBy(*keys, "_low", "_high").agg(
        at("_low", F.col("_bin")).alias("_low_bin"),
        at("_high", F.col("_bin")).alias("_high_bin"),
        at("_low", F.col("_upto") - F.col("_n")).alias("_before"),
        at("_low", F.col("_min")).alias("_low_min"),
        at("_low", F.col("_max")).alias("_low_max"),
        at("_high", F.col("_min")).alias("_high_min"),
    )
    again = (F.col("_low_bin") == F.col("_high_bin")) & (F.col("_low_min") < F.col("_low_max"))
    return found.select(
        *keys,
        F.when(~again, (F.col("_low_max") + F.col("_high_min")) / 2).alias("median"),
        (F.col("_low") - F.col("_before")).alias("_low"),
        (F.col("_high") - F.col("_before")).alias("_high"),
        F.when(again, F.col("_low_min")).alias("_least"),
        F.when(again, F.col("_low_max")).alias("_most"),
    )
