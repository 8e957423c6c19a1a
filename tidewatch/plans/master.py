"""Staging table -> versioned history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import history
from ..operators.joins import latest_per_key
from ..schemas import KEYS, MASTER
from ..session import cut_lineage, job_folders
from ..sources import tables

#: Partitions of the history: the batch that ended a row, 0 for open rows, and its publish year.
PARTS = ["ended_in", "year_published"]
TIE_BREAKERS = ["dateUpdated", "datePublished", "descriptions"]


def merge_batch(spark: SparkSession, staging: DataFrame, root: str, version: int,
                valid_from: Column | None = None) -> DataFrame:
    """Write version ``version`` of the history from the version before it."""
    moment = F.current_timestamp() if valid_from is None else valid_from
    before = (tables.read_version(spark, root, version - 1) if version > 1
              else spark.createDataFrame([], MASTER))
    batch = history.to_master(staging, moment)
    with job_folders(spark):
        merged = history.scd2_merge(
            before, batch, tie_breakers=TIE_BREAKERS,
            cut=lambda df: cut_lineage(df, "batch"))
        tables.write_version(merged, root, version)
    return tables.read_version(spark, root, version)


def read_history(spark: SparkSession, root: str, schema: StructType | str = MASTER,
                 opened: bool | None = None) -> DataFrame:
    """Rows of a partitioned history with ``PARTS``; ``opened`` reads the folders of one kind alone.

    ``schema`` is that of the rows without ``PARTS``.
    """
    plain = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parts = [StructField(c, IntegerType()) for c in PARTS]
    rows = spark.read.schema(StructType([*plain.fields, *parts])).parquet(root)
    if opened is None:
        return rows
    return rows.filter(F.col("ended_in") == 0 if opened else F.col("ended_in") != 0)


def start_history(rows: DataFrame, root: str, published: str = "datePublished") -> None:
    """Lay a first history out by ``PARTS``; rows that ended before are filed under -1."""
    laid_out = rows.withColumns({
        "ended_in": F.when(F.coalesce("currentFlag", F.lit(False)), 0).otherwise(-1),
        "year_published": F.year(published)})
    tables.overwrite_table(laid_out, root, PARTS)


def apply_batch(spark: SparkSession, root: str, batch: DataFrame, number: int,
                ends: Callable[[Column, Column], Column], keys: list[str] = KEYS,
                published: str = "datePublished") -> None:
    """Merge batch ``number`` (from 1) into the history below ``root``, in place.

    ``batch`` holds one row per key. The open rows of all years are searched for its keys by their
    key columns alone; only years in which some key is open or comes in are then read as a whole,
    once, and only their open rows are written. Rows that end are added as folders of their own, and
    no folder of ended rows is ever read or replaced.

    A run that broke off can be run again: ended rows are in place before their open rows go, and a
    year that was done shows no change the second time.
    """
    with job_folders(spark):
        opened = read_history(spark, root, batch.schema, opened=True)
        batch = cut_lineage(batch.withColumn("year_published", F.year(published)), "batch")
        found = opened.select(*keys, "year_published").join(
            batch.select(*keys), keys, "left_semi").select("year_published")
        touched = cut_lineage(found.unionByName(batch.select("year_published")).distinct(), "years")
        # calendar years
        years = [r.year_published for r in touched.collect()]
        wanted = F.col("year_published").isin([y for y in years if y is not None])
        if None in years:
            wanted = wanted | F.col("year_published").isNull()
        changes = cut_lineage(history.merge_changes(
            opened.filter(wanted).drop("ended_in"), batch, ends, keys), "changes")
        ended = changes.filter("_change = 'ended'").drop("_change").withColumn(
            "ended_in", F.lit(number))
        tables.overwrite_table(ended, root, PARTS, dynamic=True)
        left = changes.filter("_change != 'ended'").drop("_change").withColumn("ended_in", F.lit(0))
        tables.replace_partitions(left, root, PARTS, touched.withColumn("ended_in", F.lit(0)))


def merge_partitioned(spark: SparkSession, staging: DataFrame, root: str, number: int,
                      valid_from: Column | None = None) -> DataFrame:
    """Merge a staging table into the partitioned history as batch ``number``, the first one as 1."""
    moment = F.current_timestamp() if valid_from is None else valid_from
    batch = latest_per_key(history.to_master(staging, moment), KEYS, ["lastModified", *TIE_BREAKERS])
    if number == 1:
        start_history(batch, root)
    else:
        apply_batch(spark, root, batch, number, history.later_modified("lastModified"))
    return read_history(spark, root)
