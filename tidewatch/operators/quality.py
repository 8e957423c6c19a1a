"""Null profile and stage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import PROFILED


def null_profile(df: DataFrame, table: str, checked_at: Column,
                 columns: list[str] = PROFILED) -> DataFrame:
    """One history row: total, NULLs and NULL percentage per column; 0.0 for an empty table."""
    counts = df.agg(F.count("*").alias("totalRecords"),
                    *[F.count_if(F.col(c).isNull()).alias(f"{c}Nulls") for c in columns])
    percent = lambda c: F.when(
        F.col("totalRecords") > 0,
        F.round(F.lit(100.0) * F.col(f"{c}Nulls") / F.col("totalRecords"), 2)).otherwise(0.0)
    return counts.select(
        F.to_date(checked_at).alias("dqcheckDate"),
        checked_at.alias("dqcheckTimestamp"),
        F.lit(table).alias("stagingTableName"),
        "totalRecords",
        *[percent(c).alias(f"{c}PercentNull") for c in columns],
        *[f"{c}Nulls" for c in columns])


def stage_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they pass, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen
