"""Denormalised view of the open rows, and the enriched rows the rollups read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nested, scoring, text
from ..schemas import LOOKUP_COLUMNS


def lookup_projection(current: DataFrame, extra: list[str] = ()) -> DataFrame:
    """23 flat columns per open row (``read_current`` output), then the ``extra`` ones."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    best = F.col("_best")
    return (
        current.withColumn("_best", scoring.best_entry(F.col("cvssData")))
        .withColumns({
            "cvssScore": best["baseScore"],
            "cvssVersion": best["version"],
            "severity": scoring.severity(best["baseScore"], missing=""),
            "source": blank(best["source"]),
            "sourceType": blank(best["type"]),
            "vectorString": blank(best["vectorString"]),
            "impactScore": best["impactScore"],
            "exploitabilityScore": best["exploitabilityScore"],
            "cweData": nested.label_list(F.col("cweData"), "cweDescription", "cweId"),
            "capecData": nested.label_list(F.col("capecData"), "capecDescription", "capecId"),
            "cvssData": F.to_json("cvssData"),
            "vendor": text.clean_name(F.col("vendor")),
            "product": text.clean_name(F.col("product")),
            **{c: text.compact_ts_or_blank(F.col(c))
               for c in ("dateReserved", "dateUpdated", "datePublic", "lastModified")},
        })
        .select(*LOOKUP_COLUMNS, *extra))


def risk_flags(df: DataFrame, vector: str = "vectorString", version: str = "cvssVersion",
               compat: bool = False) -> DataFrame:
    """Add eight booleans read from the vector.

    Each step is a column of its own, so that Spark computes it once per row.
    """
    padded = df.withColumn("_padded", F.concat(F.lit("/"), F.col(vector), F.lit("/")))
    flags = scoring.component_flags(F.col("_padded"), F.col(version), compat)
    return (padded.withColumns(flags)
                  .withColumn("is_fully_critical", scoring.fully_critical(F.col(version)))
                  .drop("_padded"))


def enrich(df: DataFrame, compat: bool = False) -> DataFrame:
    """Add the risk flags and the weighted score to lookup rows."""
    return risk_flags(df, compat=compat).withColumn(
        "weighted_score", scoring.weighted_score(F.col("cvssScore"), F.col("severity")))
