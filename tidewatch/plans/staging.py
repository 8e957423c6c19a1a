"""Raw records -> staging table, and its quality row."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import feeds, quality
from ..session import cut_lineage, job_folders
from ..sources import raw as raw_source
from ..sources import tables


def stage_day(spark: SparkSession, path: str, table: str, compat: bool = False,
              counts: str | None = None) -> DataFrame:
    """Stage the records below ``path`` and append them to ``table``.

    The collapsed pulls are written once, so the JSON is read and parsed once. With ``counts`` the
    rows of each stage are appended to that table as (job, stage, position, records, counted_at); they
    are counted as they pass.
    """
    seen: list[tuple[str, Observation]] = []

    def counted(df: DataFrame, stage: str) -> DataFrame:
        if counts is None:
            return df
        df, found = quality.stage_counts(df, f"{stage}-{uuid4().hex}")
        seen.append((stage, found))
        return df

    records = counted(feeds.available_only(counted(raw_source.read_raw(spark, path), "read")), "available")
    with job_folders(spark):
        staged = feeds.stage(records, compat,
                             cut=lambda df: cut_lineage(counted(df, "collapsed"), "pulls"))
        tables.append_table(counted(staged, "staged"), table, ["ingestionDate"])
    if counts:
        rows = [(table, stage, i, found.get["records"]) for i, (stage, found) in enumerate(seen)]
        made = spark.createDataFrame(rows, "job string, stage string, position int, records bigint")
        tables.append_table(made.withColumn("counted_at", F.current_timestamp()), counts, ["job"])
    return spark.table(table)


def stage_latest(spark: SparkSession, root: str, prefix: str, compat: bool = False) -> DataFrame:
    """Stage the newest day below ``root`` into the table ``<prefix>_yyyy_MM_dd``."""
    folder = raw_source.latest_folder(spark, root)
    day = folder.rsplit("/", 1)[-1].replace("-", "_")
    return stage_day(spark, folder, f"{prefix}_{day}", compat)


def check_quality(spark: SparkSession, table: str, history: str) -> DataFrame:
    row = quality.null_profile(spark.table(table), table, F.current_timestamp())
    tables.append_table(row, history, ["dqcheckDate"])
    return spark.table(history)
