"""Merges by key that Parquet tables lack as statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import MapType


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str | Column]) -> DataFrame:
    """One row per key, the first in descending order of ``newest``.

    Spark keeps one row per key in each map task before the shuffle (WindowGroupLimit), so a hot
    key does not travel.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in newest]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    """DISTINCT that also takes top-level map columns, compared as sorted entries."""
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]
    entries = df.withColumns({c: F.array_sort(F.map_entries(c)) for c in maps}) if maps else df
    distinct = entries.distinct()
    back = {c: F.map_from_entries(c) for c in maps}
    return distinct.withColumns(back) if maps else distinct


def attach(df: DataFrame, aggregate: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of a per-key aggregate."""
    return df.join(aggregate, keys, "left")


def delete_where_exists(df: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(doomed.select(*keys), keys, "left_anti")


def full_merge(left: DataFrame, right: DataFrame, keys: list[str],
               columns: dict[str, Column]) -> DataFrame:
    """Full outer merge of two sides that hold one row per key.

    ``columns`` name the output and use the aliases ``l`` and ``r``, for example
    ``F.coalesce("l.score", "r.score")``.
    """
    joined = left.alias("l").join(right.alias("r"), keys, "full")
    return joined.select(*keys, *[c.alias(n) for n, c in columns.items()])


def prefer_filled(first: str, second: str) -> Column:
    """The first array unless it is empty or NULL."""
    return F.when(F.size(first) > 0, F.col(first)).otherwise(F.col(second))


def first_available(preferred: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Whole row of the preferred side, else of the other one. Both have the same columns."""
    names = [c for c in preferred.columns if c != key]
    row = F.struct(*names)
    joined = (preferred.select(key, row.alias("_p"))
              .join(other.select(key, row.alias("_o")), key, "full"))
    return joined.select(key, F.coalesce("_p", "_o").alias("_row")).select(key, "_row.*")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 changed: list[str]) -> DataFrame:
    """Matched rows take the source where one of ``changed`` differs; unmatched ones are added.

    ``source`` holds one row per key. A NULL on either side is not a difference.
    """
    names = target.columns
    joined = (target.select(*keys, F.struct(*names).alias("_t"))
              .join(source.select(*keys, F.struct(*names).alias("_s")), keys, "full"))
    differs = F.lit(False)
    for c in changed:
        differs = differs | F.coalesce(F.col(f"_t.{c}") != F.col(f"_s.{c}"), F.lit(False))
    take_source = F.col("_t").isNull() | (F.col("_s").isNotNull() & differs)
    return joined.select(F.when(take_source, F.col("_s")).otherwise(F.col("_t")).alias("_row")
                         ).select("_row.*")


def upsert_documents(target: DataFrame, incoming: DataFrame, key: str, newest: list[str],
                     corrupt: str | None = None) -> DataFrame:
    """Replace by key, add new keys; unreadable documents are skipped."""
    usable = incoming.filter(F.col(key).isNotNull())
    if corrupt:
        usable = usable.filter(F.col(corrupt).isNull()).drop(corrupt)
    fresh = latest_per_key(usable, [key], newest)
    return delete_where_exists(target, fresh, [key]).unionByName(fresh.select(*target.columns))
