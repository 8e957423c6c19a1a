"""Rollups, running totals and thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring
from ..operators import thresholds
from ..operators import rollups as ops
from ..session import cut_lineage
from . import query
from .tables import enriched, findings_sql, rating_sql, read

MEASURES_SQL = """
  count(DISTINCT cve) AS total_cves,
  round(sum(DISTINCT weight), 2) AS threat_index,
  count(DISTINCT CASE WHEN severity = 'Critical' THEN cve END) AS critical_count,
  count(DISTINCT CASE WHEN severity = 'High' THEN cve END) AS high_count,
  count(DISTINCT CASE WHEN severity = 'Medium' THEN cve END) AS medium_count,
  count(DISTINCT CASE WHEN severity = 'Low' THEN cve END) AS low_count,
  round(sum(DISTINCT CASE WHEN net THEN weight END), 2) AS network_threat_index,
  count(DISTINCT CASE WHEN net THEN cve END) AS network_cves,
  count(DISTINCT CASE WHEN no_ui THEN cve END) AS no_ui_cves,
  count(DISTINCT CASE WHEN low_priv THEN cve END) AS low_priv_cves,
  count(DISTINCT CASE WHEN fully THEN cve END) AS fully_critical_cves
"""


def _keyed(view: str) -> bool:
    return not view.endswith("global")


def _extra_sql(view: str) -> str:
    grain, level = view.split("_")
    if grain == "monthly":
        return ", make_date(year_published, month_published, 1) AS month_date"
    if grain == "ytd":
        return ", make_date(year_published, 1, 1) AS year_date"
    missing = {"global": ["vendor", "product"], "vendor": ["product"], "product": []}[level]
    return "".join(f", CAST(NULL AS VARCHAR) AS {c}" for c in missing)


def rollup_body(view: str, source: str = "findings") -> str:
    keys = ", ".join(ops.view_keys(view))
    return f"SELECT {keys}, {MEASURES_SQL} FROM {source} GROUP BY {keys}"


def rollup_sql(view: str) -> str:
    return f"""WITH {findings_sql(_keyed(view))}, grouped AS ({rollup_body(view)})
SELECT *{_extra_sql(view)}, {rating_sql('threat_index', view)} AS risk_rating FROM grouped"""


def running_sql(level: str) -> str:
    view = f"daily_{level}"
    keys = ops.LEVEL_KEYS[level]
    parts = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""WITH daily AS ({rollup_sql(view)}), summed AS (
  SELECT *, round(sum(threat_index) OVER ({parts} ORDER BY date_published
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cumulative_threat_index FROM daily)
SELECT *, {rating_sql('cumulative_threat_index', f'ytd_{level}')} AS running_risk_rating FROM summed"""


def _register(view: str) -> None:
    @query(f"rollup_{view}", rollup_sql(view))
    def run(spark, sf_dir):
        return ops.rollup(enriched(spark, sf_dir, _keyed(view)), view)


def _register_running(level: str) -> None:
    @query(f"running_{level}", running_sql(level))
    def run(spark, sf_dir):
        daily = ops.rollup(enriched(spark, sf_dir, level != "global"), f"daily_{level}")
        return ops.running_total(daily, level)


for _view in ops.ALL_VIEWS:
    _register(_view)
for _level in ops.LEVEL_KEYS:
    _register_running(_level)


@query("rollup_by_id", f"""WITH {findings_sql()}, per_cve AS (
  SELECT vendor, year_published, cve, max(weight) AS weight, arg_max(severity, weight) AS severity,
    bool_or(net) AS net, bool_or(no_ui) AS no_ui, bool_or(low_priv) AS low_priv,
    bool_or(fully) AS fully
  FROM findings GROUP BY ALL), grouped AS (
{rollup_body('ytd_vendor', 'per_cve').replace('DISTINCT weight', 'weight').replace('DISTINCT CASE WHEN net THEN weight', 'CASE WHEN net THEN weight')})
SELECT *, make_date(year_published, 1, 1) AS year_date,
  {rating_sql('threat_index', 'ytd_vendor')} AS risk_rating FROM grouped""")
def rollup_by_id(spark, sf_dir):
    return ops.rollup(enriched(spark, sf_dir), "ytd_vendor", dedupe="id")


LEVELS_CTE = f"""{findings_sql()}, levels AS (
{" UNION ALL ".join(f"SELECT '{v}' AS level, threat_index FROM ({rollup_body(v)})" for v in ops.ALL_VIEWS)}
)"""
STATS_CTE = f"""{LEVELS_CTE}, q AS (
  SELECT level, count(*) AS total_count, min(threat_index) AS min_val, max(threat_index) AS max_val,
    quantile_disc(threat_index, 0.25) AS q1, quantile_disc(threat_index, 0.5) AS q2,
    quantile_disc(threat_index, 0.75) AS q3
  FROM levels GROUP BY level), stats AS (
  SELECT level, total_count, min_val, max_val, round(q1, 2) AS p25, round(q2, 2) AS median,
    round(q3, 2) AS p75, ceil(q1) AS low_threshold, ceil(q2) AS med_threshold,
    ceil(q3) AS high_threshold FROM q)"""
BUCKETS_CTE = f"""{STATS_CTE}, buckets AS (
  SELECT level,
    count(*) FILTER (threat_index = 0) AS cnt_none,
    count(*) FILTER (threat_index > 0 AND threat_index <= low_threshold) AS cnt_low,
    count(*) FILTER (threat_index > low_threshold AND threat_index <= med_threshold) AS cnt_moderate,
    count(*) FILTER (threat_index > med_threshold AND threat_index <= high_threshold) AS cnt_high,
    count(*) FILTER (threat_index > high_threshold) AS cnt_critical
  FROM levels JOIN stats USING (level) GROUP BY level)"""


def levels(spark, sf_dir):
    return ops.rollups(enriched(spark, sf_dir)).select("level", "threat_index")


@query("union_levels", f"WITH {LEVELS_CTE} SELECT level, threat_index FROM levels")
def union_levels(spark, sf_dir):
    tagged = cut_lineage(ops.rollups(enriched(spark, sf_dir)), "rollups")
    return thresholds.union_levels({v: ops.split_view(tagged, v) for v in ops.ALL_VIEWS})


@query("threshold_stats", f"WITH {STATS_CTE} SELECT * FROM stats")
def threshold_stats(spark, sf_dir):
    return thresholds.threshold_stats(levels(spark, sf_dir))


@query("threshold_stats_by_id", f"""WITH {findings_sql()},
by_day AS (SELECT vendor, product, date_published, cve, max(weight) AS weight FROM findings GROUP BY ALL),
by_year AS (SELECT vendor, year_published, cve, max(weight) AS weight FROM findings GROUP BY ALL),
levels AS (SELECT 'daily_product' AS level, round(sum(weight), 2) AS threat_index FROM by_day GROUP BY vendor, product, date_published
  UNION ALL SELECT 'ytd_vendor', round(sum(weight), 2) FROM by_year GROUP BY vendor, year_published),
q AS (SELECT level, count(*) AS total_count, min(threat_index) AS min_val, max(threat_index) AS max_val,
    quantile_disc(threat_index, [0.25, 0.5, 0.75]) AS q FROM levels GROUP BY level)
SELECT level, total_count, min_val, max_val, round(q[1], 2) AS p25, round(q[2], 2) AS median, round(q[3], 2) AS p75,
  ceil(q[1]) AS low_threshold, ceil(q[2]) AS med_threshold, ceil(q[3]) AS high_threshold FROM q""")
def threshold_stats_by_id(spark, sf_dir):
    """Every CVE adds its weight, so a level has about as many values as rows."""
    rows = enriched(spark, sf_dir)
    by_id = {v: ops.rollup(rows, v, dedupe="id") for v in ("daily_product", "ytd_vendor")}
    return thresholds.threshold_stats(thresholds.union_levels(by_id))


@query("bucket_counts", f"WITH {BUCKETS_CTE} SELECT * FROM buckets")
def bucket_counts(spark, sf_dir):
    rows = cut_lineage(levels(spark, sf_dir), "levels")  # read by both sides
    return thresholds.bucket_counts(rows, thresholds.threshold_stats(rows))


@query("threshold_table", f"""WITH {BUCKETS_CTE}
SELECT *, 'None = 0' AS range_info,
  'Low = 1 … ' || CAST(low_threshold AS BIGINT) AS range_low,
  'Moderate = ' || (CAST(low_threshold AS BIGINT) + 1) || ' … ' || CAST(med_threshold AS BIGINT) AS range_moderate,
  'High = ' || (CAST(med_threshold AS BIGINT) + 1) || ' … ' || CAST(high_threshold AS BIGINT) AS range_high,
  'Critical = > ' || CAST(high_threshold AS BIGINT) AS range_critical
FROM stats JOIN buckets USING (level) ORDER BY level""")
def threshold_table(spark, sf_dir):
    return thresholds.threshold_table(levels(spark, sf_dir))


@query("severity_bands", f"""WITH {findings_sql(False)}
SELECT severity, count(*) AS n, min(score) AS min_score, max(score) AS max_score
FROM findings GROUP BY severity""")
def severity_bands(spark, sf_dir):
    rows = enriched(spark, sf_dir, keyed=False)
    return (rows.groupBy(scoring.severity(F.col("cvssScore")).alias("severity"))
            .agg(F.count("*").alias("n"), F.min("cvssScore").alias("min_score"),
                 F.max("cvssScore").alias("max_score")))


@query("weighted_score", f"""WITH {findings_sql(False)}
SELECT severity, weight, count(*) AS n FROM findings GROUP BY severity, weight""")
def weighted_score(spark, sf_dir):
    rows = enriched(spark, sf_dir, keyed=False)
    band = scoring.severity(F.col("cvssScore"))
    return (rows.groupBy(band.alias("severity"),
                         scoring.weighted_score(F.col("cvssScore"), band).alias("weight"))
            .agg(F.count("*").alias("n")))


@query("risk_rating", "SELECT o_orderkey, " + ", ".join(
    f"{rating_sql('(CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_totalprice / 1000 END)', lv)} AS {lv}"
    for lv in scoring.LADDERS) + " FROM orders")
def risk_rating(spark, sf_dir):
    index = F.when(F.col("o_custkey") % 50 != 0, F.col("o_totalprice") / 1000)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", *[scoring.risk_rating(index, lv).alias(lv) for lv in scoring.LADDERS])
