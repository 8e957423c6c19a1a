"""Rating thresholds derived from the spread of the index at each level."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import running_sums

Cut = Callable[[DataFrame], DataFrame]
STATS = ["total_count", "min_val", "max_val", "p25", "median", "p75",
         "low_threshold", "med_threshold", "high_threshold"]
_CUTS = ["low_threshold", "med_threshold", "high_threshold"]


def union_levels(views: dict[str, DataFrame]) -> DataFrame:
    """(level, threat_index) rows of all views."""
    tagged = [df.select(F.lit(name).alias("level"), "threat_index") for name, df in views.items()]
    return reduce(DataFrame.unionByName, tagged)


def _value_counts(levels: DataFrame) -> DataFrame:
    return levels.groupBy("level", "threat_index").agg(F.count("*").alias("_n"))


def _counts(df: DataFrame) -> DataFrame:
    return cut_lineage(df, "counts")


def _quartiles(counts: DataFrame) -> DataFrame:
    """(level, total_count, min_val, max_val, q1, q2, q3) of value counts.

    A quartile is the smallest value that at least its share of the rows does not exceed. Values are
    dealt out by ranges and a value's rank is the prefix sum of the counts up to it, so a level of any
    number of distinct values spreads over all tasks. The value that holds the rank then comes out of
    the one range that has it, as a minimum.
    """
    level = counts.groupBy("level").agg(
        F.sum("_n").alias("total_count"), F.min("threat_index").alias("min_val"),
        F.max("threat_index").alias("max_val"))
    ranked = running_sums(counts.filter("threat_index IS NOT NULL"), ["level"], ["threat_index"],
                          {"_upto": F.col("_n")}, {"_known": "_upto"})
    share = lambda p: F.min(F.when(F.col("_upto") >= p * F.col("_known"), F.col("threat_index")))
    cut = ranked.groupBy("level").agg(share(0.25).alias("q1"), share(0.5).alias("q2"),
                                      share(0.75).alias("q3"))
    return level.join(cut, "level", "left")


def _stats(counts: DataFrame) -> DataFrame:
    """One row per level with ``STATS``; the cut points are rounded up."""
    return _quartiles(counts).withColumns({
        "p25": F.round("q1", 2), "median": F.round("q2", 2), "p75": F.round("q3", 2),
        "low_threshold": F.ceil("q1").cast("double"),
        "med_threshold": F.ceil("q2").cast("double"),
        "high_threshold": F.ceil("q3").cast("double")}).select("level", *STATS)


def _buckets() -> list[Column]:
    index = F.col("threat_index")
    low, med, high = (F.col(f"{n}_threshold") for n in ("low", "med", "high"))
    between = {
        "cnt_none": index == 0,
        "cnt_low": (index > 0) & (index <= low),
        "cnt_moderate": (index > low) & (index <= med),
        "cnt_high": (index > med) & (index <= high),
        "cnt_critical": index > high,
    }
    return [F.sum(F.when(c, F.col("_n")).otherwise(0)).alias(n) for n, c in between.items()]


def threshold_stats(levels: DataFrame, cut: Cut = _counts) -> DataFrame:
    """Count, range and exact quartiles per level; the cut points are rounded up.

    No level passes through one task, whatever its number of distinct values.
    """
    return _stats(cut(_value_counts(levels)))


def bucket_counts(levels: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Rows per level between the cut points of a threshold table.

    Equal values are counted first; the threshold side is as small as the caller's levels are few.
    """
    cuts = thresholds.select("level", *_CUTS)
    return (_value_counts(levels).join(cuts, "level")
            .groupBy("level").agg(*_buckets()))


def threshold_table(levels: DataFrame, cut: Cut = _counts) -> DataFrame:
    """Statistics, cut points, bucket sizes and readable ranges, ordered by level.

    Equal values are counted once, and written, as the statistics and the buckets both read them.
    """
    counts = cut(_value_counts(levels))
    stats = _stats(counts)
    sized = counts.join(stats.select("level", *_CUTS), "level").groupBy("level").agg(*_buckets())
    whole = lambda c, add=0: (F.col(c).cast("bigint") + add).cast("string")
    upto = lambda name, lo, hi: F.concat(
        F.lit(f"{name} = "), whole(lo, 1), F.lit(" … "), whole(hi))
    return (
        stats.join(sized, "level")
        .select(
            "level", "total_count", "min_val", "p25", "median", "p75", "max_val",
            "low_threshold", "med_threshold", "high_threshold",
            "cnt_none", "cnt_low", "cnt_moderate", "cnt_high", "cnt_critical",
            F.lit("None = 0").alias("range_info"),
            F.concat(F.lit("Low = 1 … "), whole("low_threshold")).alias("range_low"),
            upto("Moderate", "low_threshold", "med_threshold").alias("range_moderate"),
            upto("High", "med_threshold", "high_threshold").alias("range_high"),
            F.concat(F.lit("Critical = > "), whole("high_threshold")).alias("range_critical"))
        .orderBy("level"))
