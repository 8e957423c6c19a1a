"""Prefix sums over ordered groups of any size.

A plain window over a group puts all its rows into one task. Here rows are dealt out by ranges of
(group, order), so that a large group spreads over many tasks. Each range is summed on its own, and
the totals of the ranges before, of which a group has no more than there are ranges, are added.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

Cut = Callable[[DataFrame], DataFrame]


def _ranges(df: DataFrame) -> DataFrame:
    return cut_lineage(df, "ranges")


def same_keys(left: DataFrame | str, right: DataFrame | str, keys: list[str]) -> Column:
    """Equality of all ``keys`` of two frames or aliases; two NULLs are equal."""
    of = lambda side, k: F.col(f"{side}.{k}") if isinstance(side, str) else side[k]
    return reduce(Column.__and__, [of(left, k).eqNullSafe(of(right, k)) for k in keys])


def running_sums(df: DataFrame, group: list[str], order: list[str], sums: dict[str, Column],
                 totals: dict[str, str] | None = None, cut: Cut = _ranges) -> DataFrame:
    """``df`` with a column for each of ``sums``: the sum up to and with the row in its group.

    ``totals`` names further columns with the sum over the whole group: ``{"all_bytes": "bytes"}``.
    ``order`` must tell the rows of a group apart where the result is to be the same in every run;
    NULLs come first. A NULL amount counts nothing. ``cut`` has to write the ranges: they are read
    twice and their numbers must stay.
    """
    names = list(sums)
    ranged = cut(df.withColumns(sums).repartitionByRange(*[F.col(c) for c in [*group, *order]])
                 .withColumn("_range", F.spark_partition_id()))
    upto = (Window.partitionBy("_range", *group).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = ranged.withColumns({n: F.coalesce(F.sum(n).over(upto), F.lit(0)) for n in names})
    # as many rows as there are ranges, and one more for each border between groups
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy(*group, "_range").agg(*[F.sum(n).alias(n) for n in names])
    offsets = per_range.select(
        *group, "_range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names],
        *[F.coalesce(F.sum(n).over(whole), F.lit(0)).alias(t) for t, n in (totals or {}).items()])
    keys = [*group, "_range"]
    joined = inside.alias("r").join(offsets.alias("o"), same_keys("r", "o", keys))
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns if c not in names],
        *[(F.col(f"r.{n}") + F.col(f"o._before_{n}")).alias(n) for n in names],
        *[F.col(f"o.{t}") for t in totals or {}])
