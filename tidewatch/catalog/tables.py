"""Vulnerability-like rows derived from the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scoring
from ..operators.lookup import enrich


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def vector_string() -> Column:
    """A v2 vector for line numbers from 6 on, else a v3.1 one."""
    pick = lambda when, yes, no: F.when(when, yes).otherwise(no)
    part = lambda name, value: F.concat(F.lit(f"{name}:"), value)
    access = part("AV", pick(F.col("l_returnflag") == "R", "N", "L"))
    seen = F.col("l_linestatus") == "F"
    v2 = F.concat_ws("/", access, F.lit("AC:L"), part("Au", pick(seen, "N", "S")),
                     F.lit("C:P/I:P/A:P"))
    privileges = (F.when(F.col("l_discount") <= 0.02, "N")
                  .when(F.col("l_discount") <= 0.05, "L").otherwise("H"))
    v3 = F.concat_ws(
        "/", F.lit("CVSS:3.1"), access, F.lit("AC:L"), part("PR", privileges),
        part("UI", pick(seen, "N", "R")), part("S", pick(F.col("l_tax") <= 0.04, "C", "U")),
        part("C", pick(F.col("l_quantity") >= 35, "H", "L")),
        part("I", pick(F.col("l_suppkey") % 2 == 0, "H", "N")), F.lit("A:L"))
    return F.when(F.col("l_linenumber") >= 6, v2).otherwise(v3)


VECTOR_SQL = """
CASE WHEN l_linenumber >= 6 THEN
  concat('AV:', CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'L' END, '/AC:L/Au:',
         CASE WHEN l_linestatus = 'F' THEN 'N' ELSE 'S' END, '/C:P/I:P/A:P')
ELSE
  concat('CVSS:3.1/AV:', CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'L' END, '/AC:L/PR:',
         CASE WHEN l_discount <= 0.02 THEN 'N' WHEN l_discount <= 0.05 THEN 'L' ELSE 'H' END,
         '/UI:', CASE WHEN l_linestatus = 'F' THEN 'N' ELSE 'R' END,
         '/S:', CASE WHEN l_tax <= 0.04 THEN 'C' ELSE 'U' END,
         '/C:', CASE WHEN l_quantity >= 35 THEN 'H' ELSE 'L' END,
         '/I:', CASE WHEN l_suppkey % 2 = 0 THEN 'H' ELSE 'N' END, '/A:L')
END
"""


def base_score() -> Column:
    return F.when(F.col("l_tax") < 0.08, F.col("l_quantity") / 5)


def version() -> Column:
    return F.when(F.col("l_linenumber") >= 6, "2.0").otherwise("3.1")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem")


def _findings(spark: SparkSession, sf_dir: str, keyed: bool, **columns: Column) -> DataFrame:
    """One finding per line item, keyed by its part; no join where the keys are not wanted."""
    rows = lineitem(spark, sf_dir)
    keys = []
    if keyed:
        part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
        rows = rows.join(part, rows.l_partkey == part.p_partkey)
        keys = [F.col("p_brand").alias("vendor"), F.col("p_type").alias("product")]
    scored = rows.select(
        *keys, F.col("l_orderkey").alias("cveId"), F.col("l_shipdate").alias("datePublished"),
        base_score().alias("cvssScore"), *[c.alias(n) for n, c in columns.items()])
    return scored.withColumn("severity", scoring.severity(F.col("cvssScore"), missing=""))


def findings(spark: SparkSession, sf_dir: str, keyed: bool = True) -> DataFrame:
    """Lookup-like rows with a vector text."""
    return _findings(spark, sf_dir, keyed, cvssVersion=version(), vectorString=vector_string(),
                     year_published=F.year("l_shipdate"), date_published=F.to_date("l_shipdate"))


def enriched(spark: SparkSession, sf_dir: str, keyed: bool = True) -> DataFrame:
    """The same rows with the flags read from their vectors, and their weight."""
    return enrich(findings(spark, sf_dir, keyed))


def findings_sql(keyed: bool = True) -> str:
    """The same rows with flags and weights worked out from the columns themselves."""
    keys = "p_brand AS vendor, p_type AS product," if keyed else ""
    source = "lineitem JOIN part ON l_partkey = p_partkey" if keyed else "lineitem"
    return f"""
scored AS (
  SELECT {keys} l_orderkey AS cve, l_shipdate, CAST(l_shipdate AS DATE) AS date_published,
    CAST(year(l_shipdate) AS INTEGER) AS year_published,
    CAST(month(l_shipdate) AS INTEGER) AS month_published,
    CASE WHEN l_tax < 0.08 THEN l_quantity / 5 END AS score,
    l_returnflag = 'R' AS net, l_linestatus = 'F' AS no_ui,
    CASE WHEN l_linenumber >= 6 THEN l_linestatus = 'F' ELSE l_discount <= 0.05 END AS low_priv,
    l_linenumber < 6 AND l_tax <= 0.04 AS scope_changed,
    l_linenumber < 6 AND l_quantity >= 35 AS high_conf,
    l_linenumber < 6 AND l_suppkey % 2 = 0 AS high_int
  FROM {source}
),
findings AS (
  SELECT *,
    CASE WHEN score >= 9 THEN 'Critical' WHEN score >= 7 THEN 'High' WHEN score >= 4 THEN 'Medium'
         WHEN score IS NOT NULL THEN 'Low' END AS severity,
    CASE WHEN score >= 9 THEN score WHEN score >= 7 THEN score * 0.75
         WHEN score >= 4 THEN score * 0.5 WHEN score IS NOT NULL THEN score * 0.25
         ELSE 0.0 END::DOUBLE AS weight,
    net AND no_ui AND low_priv AND scope_changed AND (high_conf OR high_int) AS fully
  FROM scored
)"""


def rating_sql(index: str, level: str) -> str:
    bands = " ".join(f"WHEN {index} > {bound} THEN '{name}'"
                     for name, bound in zip(scoring.RATINGS, scoring.LADDERS[level]))
    return f"CASE WHEN {index} IS NULL THEN 'Unknown' {bands} ELSE 'None' END"
