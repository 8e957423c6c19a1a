"""Raw feed records built from the orders table, staged by the real operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import feeds, quality
from ..session import cut_lineage
from . import query
from .tables import ntz, read


def _iso(c):
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))


def _said(lang, value):
    return F.struct(F.lit(lang).alias("lang"), value.alias("value"))


def _number(c, modulus):
    return F.col(c) % modulus


def cna_document():
    """CNA/ADP document of an order as JSON text."""
    cust, day = F.col("o_custkey"), F.col("o_orderdate")
    score = lambda base: F.struct(F.struct(
        F.lit("3.1").alias("version"), F.lit("CVSS:3.1/AV:N").alias("vectorString"),
        base.cast("double").alias("baseScore")).alias("cvssV3_1"))
    open_metric = F.struct(F.lit(None).cast(
        "struct<version: string, vectorString: string, baseScore: double>").alias("cvssV3_1"))
    problem = lambda ident, label: F.array(F.struct(F.array(F.struct(
        F.concat(F.lit("CWE-"), ident.cast("string")).alias("cweId"), F.lit(label).alias("description"),
        F.lit("en").alias("lang"), F.lit("CWE").alias("type"))).alias("descriptions")))
    impact = F.struct(
        F.concat(F.lit("CAPEC-"), _number("o_custkey", 6).cast("string")).alias("capecId"),
        F.array(_said("en", F.lit("x")), _said("es", F.lit("y"))).alias("descriptions"))
    cna = F.struct(
        _iso(day).alias("datePublic"),
        F.array(_said("en", F.concat(F.lit("cna "), "o_orderstatus"))).alias("descriptions"),
        F.array(impact).alias("impacts"),
        F.array(F.when(cust % 4 != 0, score(cust % 7 + 1)).otherwise(open_metric)).alias("metrics"),
        problem(_number("o_custkey", 5), "d").alias("problemTypes"))
    adp = F.array(F.struct(problem(_number("o_custkey", 3), "e").alias("problemTypes"),
                           F.array(score(F.lit(3.5))).alias("metrics")))
    meta = F.struct(_iso(day).alias("datePublished"), F.lit("not a date").alias("dateReserved"),
                    _iso(F.expr("o_orderdate + INTERVAL 1 DAY")).alias("dateUpdated"))
    return F.to_json(F.struct(meta.alias("cveMetadata"),
                              F.struct(cna.alias("cna"), adp.alias("adp")).alias("containers")))


def nvd_document():
    """NVD document of an order as JSON text."""
    cust = F.col("o_custkey")
    entry = lambda ver, base: F.array(F.struct(
        F.lit("nvd").alias("source"), F.lit("Primary").alias("type"),
        F.struct(F.lit(ver).alias("version"), F.lit("AV:N").alias("vectorString"),
                 base.cast("double").alias("baseScore")).alias("cvssData"),
        F.lit(1.0).alias("exploitabilityScore"), F.lit(2.0).alias("impactScore")))
    v31 = entry("3.1", cust % 100 / 10)
    metrics = (F.when(F.col("o_orderkey") % 13 == 0, F.lit(None))
               .when(cust % 2 == 0, F.create_map(F.lit("cvssMetricV31"), v31,
                                                 F.lit("cvssMetricV2"), entry("2.0", F.lit(5))))
               .otherwise(F.create_map(F.lit("cvssMetricV31"), v31)))
    english = F.when(F.col("o_orderkey") % 11 != 0, "en-US").otherwise("fr")
    said = F.array(_said("es", F.lit("no")), F.struct(english.alias("lang"), F.concat(
        F.lit("<b>"), "o_orderpriority", F.lit("</b> text")).alias("value")))
    weakness = F.array(F.struct(F.array(_said("en", F.concat(
        F.lit("CWE-"), _number("o_custkey", 4).cast("string")))).alias("description")))
    return F.to_json(F.struct(
        F.concat(F.lit("CVE-"), F.col("o_orderkey").cast("string")).alias("id"),
        _iso(F.expr("o_orderdate + INTERVAL 2 DAY")).alias("published"),
        _iso(F.expr("o_orderdate + make_dt_interval(o_custkey % 30)")).alias("lastModified"),
        F.concat(F.lit("S"), _number("o_custkey", 3).cast("string")).alias("vulnStatus"),
        said.alias("descriptions"), metrics.alias("metrics"), weakness.alias("weaknesses")))


def raw_records(spark, sf_dir):
    """Two pulls per order. The first repeats the CNA pair; the NVD pair is in either one."""
    key = F.col("o_orderkey")
    none = F.array().cast("array<array<string>>")
    cna_pair = F.array(F.concat(F.lit(" cve-"), key.cast("string"), F.lit("é ")), cna_document())
    nvd_pair = F.array(key.cast("string"), nvd_document())
    pull = lambda at, cna, nvd: F.struct(
        F.lit("2025-05-03").alias("ingestionDate"), F.lit(at).alias("ingestionTimestamp"),
        cna.alias("cvelistv5"), nvd.alias("fkie_nvd"))
    cna = F.when(key % 3 != 0, F.array_repeat(cna_pair, 2)).otherwise(none)
    nvd_in = lambda rest: F.when((key % 5 != 0) & (key % 2 == rest), F.array(nvd_pair)
                                 ).otherwise(none)
    pulls = F.array(pull("2025-05-03T10:00:00.000001+00:00", cna, nvd_in(1)),
                    pull("2025-05-03T11:00:00+00:00", none, nvd_in(0)))
    return (read(spark, sf_dir, "orders")
            .select(F.col("o_orderpriority").alias("vendor"), F.col("o_orderstatus").alias("product"),
                    F.explode(pulls).alias("p"))
            .select("vendor", "product", "p.*"))


def typed_records(spark, sf_dir):
    flagged = feeds.available_only(feeds.availability_flag(raw_records(spark, sf_dir)))
    return flagged.withColumns({
        "ingestionTimestamp": text.pull_timestamp(F.col("ingestionTimestamp")),
        "ingestionDate": F.to_date("ingestionDate")})


STAGED_CTE = """
o AS (SELECT *, o_orderkey % 3 <> 0 AS has_cna,
    o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 AS has_nvd FROM orders),
cwe_rows AS (
  SELECT o_orderkey, 'CWE-' || (o_custkey % 5) AS id, 'd' AS label FROM o WHERE has_cna
  UNION ALL SELECT o_orderkey, 'CWE-' || (o_custkey % 3), 'e' FROM o WHERE has_cna
  UNION ALL SELECT o_orderkey, 'CWE-' || (o_custkey % 4), NULL FROM o WHERE has_nvd),
cwe AS (SELECT o_orderkey, string_agg(concat_ws('=', id, label), ',' ORDER BY id) AS cwe
  FROM (SELECT o_orderkey, id, max(label) AS label FROM cwe_rows GROUP BY ALL) GROUP BY o_orderkey),
staged AS (
  SELECT o_orderpriority AS vendor, o_orderstatus AS product, 'CVE-' || o_orderkey AS cve, cwe,
    CASE WHEN has_cna THEN 'CAPEC-' || (o_custkey % 6) || '=x' END AS capec,
    CASE WHEN has_nvd THEN 'S' || (o_custkey % 3) END AS status,
    CASE WHEN has_nvd AND o_orderkey % 13 <> 0
         THEN '3.1:' || CAST(o_custkey % 100 / 10 AS VARCHAR)
           || CASE WHEN o_custkey % 2 = 0 THEN ',2.0:5.0' ELSE '' END
         WHEN has_cna THEN CASE WHEN o_custkey % 4 <> 0
           THEN '3.1:' || CAST(CAST(o_custkey % 7 + 1 AS DOUBLE) AS VARCHAR) ELSE '3.1:3.5' END
         END AS scores,
    CAST(CASE WHEN has_cna THEN o_orderdate ELSE o_orderdate + INTERVAL 2 DAY END AS DATE) AS published,
    CASE WHEN has_cna THEN CAST(o_orderdate + INTERVAL 1 DAY AS DATE) END AS updated,
    CASE WHEN has_nvd THEN CAST(o_orderdate + to_days(CAST(o_custkey % 30 AS INTEGER)) AS DATE) END AS modified,
    CASE WHEN has_nvd THEN o_orderpriority || ' text' ELSE 'cna ' || o_orderstatus END AS description,
    epoch_us(CASE WHEN has_cna OR o_orderkey % 2 = 1 THEN TIMESTAMP '2025-05-03 10:00:00.000001'
                  ELSE TIMESTAMP '2025-05-03 11:00:00' END) AS pulled_at
  FROM o LEFT JOIN cwe USING (o_orderkey) WHERE has_cna OR has_nvd)
"""


def _flat(staged):
    """Staging rows with their arrays as text."""
    joined = lambda arr, f: F.array_join(F.transform(arr, f), ",")
    return staged.select(
        "vendor", "product", F.col("cveId").alias("cve"),
        joined("cweData", lambda x: F.concat_ws("=", x["cweId"], x["cweDescription"])).alias("cwe"),
        joined("capecData", lambda x: F.concat_ws("=", x["capecId"], x["capecDescription"]))
        .alias("capec"),
        F.col("vulnStatus").alias("status"),
        joined("cvssData", lambda x: F.concat_ws(":", x["version"], x["baseScore"].cast("string")))
        .alias("scores"),
        F.to_date("datePublished").alias("published"), F.to_date("dateUpdated").alias("updated"),
        F.to_date("lastModified").alias("modified"), F.col("Descriptions").alias("description"),
        F.unix_micros("ingestionTimestamp").alias("pulled_at"))


@query("staged_feed", f"WITH {STAGED_CTE} SELECT * FROM staged")
def staged_feed(spark, sf_dir):
    return _flat(feeds.stage(typed_records(spark, sf_dir), cut=cut_lineage))


@query("null_profile", f"""WITH {STAGED_CTE}, c AS (
  SELECT count(*) AS n, count(*) FILTER (capec IS NULL) AS capec, count(*) FILTER (status IS NULL) AS status,
    count(*) FILTER (scores IS NULL) AS scores, count(*) FILTER (updated IS NULL) AS updated FROM staged)
SELECT DATE '2025-05-04' AS "dqcheckDate", TIMESTAMP '2025-05-04 01:02:03' AS "dqcheckTimestamp",
  'orders_feed' AS "stagingTableName", n AS "totalRecords",
  {", ".join(f'CAST({e} AS BIGINT) AS "{c}Nulls", CASE WHEN n > 0 THEN round(100.0::DOUBLE * {e} / n, 2) ELSE 0.0::DOUBLE END AS "{c}PercentNull"'
             for c, e in {"vendor": "0", "product": "0", "cveId": "0", "cweData": "0",
                          "capecData": "capec", "vulnStatus": "status", "cvssData": "scores",
                          "datePublished": "0", "dateReserved": "n", "dateUpdated": "updated",
                          "datePublic": "updated", "lastModified": "status",
                          "Descriptions": "0"}.items())}
FROM c""")
def null_profile(spark, sf_dir):
    staged = feeds.stage(typed_records(spark, sf_dir), cut=cut_lineage)
    return quality.null_profile(staged, "orders_feed", ntz("2025-05-04 01:02:03"))
