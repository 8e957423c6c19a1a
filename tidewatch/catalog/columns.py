"""Text, date, flag and projection operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, scoring, text
from ..operators import feeds, lookup
from ..sources import raw
from . import query
from .tables import VECTOR_SQL, base_score, lineitem, read, vector_string, version


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_published,
  CAST(month(o_orderdate) AS INTEGER) AS month_published, CAST(o_orderdate AS DATE) AS date_published,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS year_date
FROM orders""")
def date_parts(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dates.date_parts(rows, "o_orderdate").drop("o_orderdate")


@query("filter_project", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def filter_project(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("cveDataAvailable"))
    return feeds.available_only(rows)


@query("availability_flag", """
SELECT doc_id, lang = 'en' OR n_chars > 500 AS "cveDataAvailable" FROM documents""")
def availability_flag(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", F.array("source")).alias("cvelistv5"),
        F.when(F.col("n_chars") > 500, F.array("source"))
         .otherwise(F.array().cast("array<string>")).alias("fkie_nvd"))
    return feeds.availability_flag(rows).select("doc_id", "cveDataAvailable")


@query("normalize_id", """
SELECT c_custkey, upper('cve-' || c_name) AS cve_id, upper('  cve-' || c_name || ' ') AS untrimmed
FROM customer""")
def normalize_id(spark, sf_dir):
    dirty = F.concat(F.lit("  cve-"), "c_name", F.lit("é "))
    return read(spark, sf_dir, "customer").select(
        "c_custkey", text.normalize_id(dirty).alias("cve_id"),
        text.normalize_id(dirty, trim=False).alias("untrimmed"))


@query("strip_tags", """
SELECT page_id, md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS body,
  length(regexp_replace(html, '<[^>]*>', '', 'g')) AS n FROM pages""")
def strip_tags(spark, sf_dir):
    body = text.strip_tags(F.col("html"))
    return read(spark, sf_dir, "pages").select(
        "page_id", F.md5(body).alias("body"), F.length(body).cast("bigint").alias("n"))


@query("clean_name", r"""
WITH words AS (
  SELECT p_partkey, string_split(trim(replace(replace('_' || p_name || '_\of_' || p_type, '\', ''), '_', ' ')), ' ') AS w
  FROM part)
SELECT p_partkey, array_to_string(list_transform(w, lambda x: upper(x[1]) || lower(x[2:])), ' ') AS name
FROM words""")
def clean_name(spark, sf_dir):
    dirty = F.concat(F.lit("_"), "p_name", F.lit("_\\of_"), "p_type")
    return read(spark, sf_dir, "part").select("p_partkey", text.clean_name(dirty).alias("name"))


@query("compact_ts", """
SELECT event_id, rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') || ' UTC' AS at,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || ' UTC' AS at_second,
  CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, '%Y-%m-%d') || ' 00:00:00 UTC' END AS at_day
FROM events""")
def compact_ts(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return read(spark, sf_dir, "events").select(
        "event_id", text.compact_ts(F.col("ts")).alias("at"),
        text.compact_ts(F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("at_second"),
        text.compact_ts_or_blank(F.when(F.col("event_type") != "error", day)).alias("at_day"))


_SAFE = "regexp_replace(regexp_replace({}, '[^A-Za-z0-9._-]', '_', 'g'), '^[._-]+', '')"


@query("safe_name", f"""
WITH named AS (
  SELECT page_id, {_SAFE.format('url')} AS name, {_SAFE.format("'..' || html")} AS long_name,
    array_to_string(list_transform(string_split(url, '/'), lambda p:
      CASE WHEN {_SAFE.format('p')} = '' THEN 'file' ELSE {_SAFE.format('p')} END), '/') AS path,
    substr(regexp_replace(url || '_' || html, '[^A-Za-z0-9_-]', '_', 'g'), 1, 80) AS message_id
  FROM pages)
SELECT page_id, name, md5(long_name) AS long_name, path, message_id FROM named""")
def safe_name(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(
        "page_id", text.safe_name(F.col("url")).alias("name"),
        F.md5(text.safe_name(F.concat(F.lit(".."), "html"))).alias("long_name"),
        text.safe_path(F.col("url")).alias("path"),
        text.message_label(F.col("url"), F.col("html")).alias("message_id"))


@query("clean_key", """
SELECT p_partkey, lower(p_name) AS key FROM part WHERE p_size % 7 > 2""")
def clean_key(spark, sf_dir):
    kind = F.col("p_size") % 7
    dirty = (F.when(kind == 0, " N/A ").when(kind == 1, "*** n/a ***").when(kind == 2, "\t ")
             .otherwise(F.concat(F.lit(" \t"), F.upper("p_name"), F.lit("\n"))))
    return (read(spark, sf_dir, "part").select("p_partkey", text.clean_key(dirty).alias("key"))
            .filter("key IS NOT NULL"))


@query("split_parts", """
SELECT p_partkey, lower(p_brand) AS vendor, lower(p_type) AS product, CAST(NULL AS VARCHAR) AS beyond
FROM part""")
def split_parts(spark, sf_dir):
    criteria = F.concat_ws(":", F.lit("cpe:2.3:a"), F.lower("p_brand"), F.lower("p_type"),
                           F.col("p_size").cast("string"))
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.cpe_part(criteria, 3).alias("vendor"),
        text.cpe_part(criteria, 4).alias("product"), text.cpe_part(criteria, 9).alias("beyond"))


@query("url_metadata", """
SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS vendor,
  CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS product,
  CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS "ingestionDate",
  CASE WHEN event_type <> 'error' THEN strftime(ts, '%H:%M:%S') END AS pulled_at,
  event_type = 'error' AS incomplete
FROM events""")
def url_metadata(spark, sf_dir):
    suffix = F.when(F.col("event_type") == "error", ".txt").otherwise(".json")
    named = read(spark, sf_dir, "events").select("event_id", F.concat(
        "event_type", F.lit("_cve_"), F.col("user_id").cast("string"), F.lit("_raw_"),
        F.date_format("ts", "yyyy-MM-dd_HH-mm-ss"), suffix).alias("file_name"))
    return raw.file_name_metadata(named).select(
        "event_id", "vendor", "product", "ingestionDate",
        F.date_format("ingestionTimestamp", "HH:mm:ss").alias("pulled_at"), "incomplete")


_METRICS = ["AV", "AC", "C", "I", "A", "PR", "UI", "S", "Au"]


@query("vector_parse", f"""
WITH vectors AS (SELECT l_orderkey, l_linenumber, {VECTOR_SQL} AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, {", ".join(
    f"regexp_extract(v, '(^|/){m}:([^/]+)', 2) AS {m.lower()}_value" for m in _METRICS)}
FROM vectors""")
def vector_parse(spark, sf_dir):
    parts = scoring.cvss_vector(vector_string(), version())
    return lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", *[parts[m].alias(f"{m.lower()}_value") for m in _METRICS])


@query("risk_flags", """
WITH f AS (SELECT l_returnflag = 'R' AS is_network_based, l_linestatus = 'F' AS is_no_ui,
  CASE WHEN l_linenumber >= 6 THEN l_linestatus = 'F' ELSE l_discount <= 0.05 END AS is_low_priv,
  l_linenumber < 6 AND l_tax <= 0.04 AS is_scope_changed,
  l_linenumber < 6 AND l_quantity >= 35 AS is_high_conf,
  l_linenumber < 6 AND l_suppkey % 2 = 0 AS is_high_int, FALSE AS is_high_avail
  FROM lineitem)
SELECT *, is_network_based AND is_no_ui AND is_low_priv AND is_scope_changed
    AND (is_high_conf OR is_high_int) AS is_fully_critical, count(*) AS n
FROM f GROUP BY ALL""")
def risk_flags(spark, sf_dir):
    rows = lineitem(spark, sf_dir).select(
        vector_string().alias("v"), version().alias("ver"))
    flagged = lookup.risk_flags(rows, "v", "ver").drop("v", "ver")
    return flagged.groupBy(*flagged.columns).agg(F.count("*").alias("n"))


_PRIMARY = "l_tax < 0.08 AND l_quantity / 5 >= l_linenumber"
_SECONDARY = "l_tax < 0.08 AND l_quantity / 5 < l_linenumber"


def current_rows(spark, sf_dir):
    """Open history rows: one per line item, with score, weakness and pattern arrays."""
    line = F.col("l_linenumber")
    entry = lambda source, kind, ver, vector, base, impact, exploit: F.struct(
        F.lit(source).alias("source"), F.lit(kind).alias("type"), ver.alias("version"),
        vector.alias("vectorString"), base.alias("baseScore"),
        impact.cast("double").alias("impactScore"),
        exploit.cast("double").alias("exploitabilityScore"))
    scores = F.array(
        entry("nvd", "Primary", version(), vector_string(), F.col("l_quantity") / 5, line, line / 2),
        entry("cna", "Secondary", F.lit("3.0"), F.lit("AV:L"), line.cast("double"),
              F.lit(None), F.lit(None)))
    weakness = lambda ident, label: F.struct(ident.alias("cweId"), label.alias("cweDescription"))
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    rows = lineitem(spark, sf_dir)
    rows = rows.join(part, rows.l_partkey == part.p_partkey)
    shifted = F.expr("l_shipdate + make_dt_interval(0, 0, 0, l_linenumber * 0.25)")
    return rows.select(
        F.col("l_shipdate").alias("datePublished"),
        F.concat(F.lower("p_brand"), F.lit("_x\\y")).alias("vendor"),
        F.col("p_type").alias("product"),
        F.concat(F.lit("CVE-"), F.col("l_orderkey").cast("string")).alias("cveId"),
        F.col("p_name").alias("descriptions"),
        F.col("l_linestatus").alias("vulnStatus"),
        F.when(line > 1, F.array(
            weakness(F.concat(F.lit("CWE-"), line.cast("string")),
                     F.when(line % 2 == 0, F.col("p_name")).otherwise(F.lit(" "))),
            weakness(F.lit("CWE-0"), F.lit(None).cast("string")))).alias("cweData"),
        F.array(F.struct(F.lit("CAPEC-1").alias("capecId"),
                         F.col("l_returnflag").alias("capecDescription"))).alias("capecData"),
        F.when(F.col("l_tax") < 0.08, scores).alias("cvssData"),
        F.when(line > 2, shifted).alias("dateReserved"),
        F.col("l_shipdate").alias("dateUpdated"),
        F.lit(None).cast("timestamp_ntz").alias("datePublic"),
        shifted.alias("lastModified"),
        F.year("l_shipdate").alias("year_published"),
        F.to_date("l_shipdate").alias("date_published"))


_SHIFTED_SQL = ("rtrim(rtrim(strftime(l_shipdate + to_milliseconds(l_linenumber * 250), "
                "'%Y-%m-%d %H:%M:%S.%f'), '0'), '.') || ' UTC'")


@query("lookup_view", f"""
WITH r AS (SELECT *, {VECTOR_SQL} AS v, CASE WHEN l_linenumber >= 6 THEN '2.0' ELSE '3.1' END AS ver,
    CASE WHEN {_PRIMARY} THEN l_quantity / 5 WHEN {_SECONDARY} THEN CAST(l_linenumber AS DOUBLE) END AS score
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_shipdate AS "datePublished",
  upper(p_brand[1]) || lower(p_brand[2:]) || ' Xy' AS vendor,
  upper(p_type[1]) || lower(p_type[2:]) AS product,
  'CVE-' || l_orderkey AS "cveId", p_name AS descriptions, score AS "cvssScore",
  CASE WHEN score >= 9 THEN 'Critical' WHEN score >= 7 THEN 'High' WHEN score >= 4 THEN 'Medium'
       WHEN score IS NOT NULL THEN 'Low' ELSE '' END AS severity,
  CASE WHEN {_PRIMARY} THEN v WHEN {_SECONDARY} THEN 'AV:L' ELSE '' END AS "vectorString",
  CASE WHEN {_PRIMARY} THEN CAST(l_linenumber AS DOUBLE) END AS "impactScore",
  CASE WHEN {_PRIMARY} THEN l_linenumber / 2 END AS "exploitabilityScore",
  CASE WHEN {_PRIMARY} THEN 'nvd' WHEN {_SECONDARY} THEN 'cna' ELSE '' END AS source,
  CASE WHEN {_PRIMARY} THEN 'Primary' WHEN {_SECONDARY} THEN 'Secondary' ELSE '' END AS "sourceType",
  CASE WHEN {_PRIMARY} THEN ver WHEN {_SECONDARY} THEN '3.0' ELSE '' END AS "cvssVersion",
  l_linestatus AS "vulnStatus",
  CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber % 2 = 0 THEN p_name || ', CWE-0'
       ELSE 'CWE-' || l_linenumber || ', CWE-0' END AS "cweData",
  l_returnflag AS "capecData",
  CASE WHEN l_tax < 0.08 THEN
    '[{{"source":"nvd","type":"Primary","version":"' || ver || '","vectorString":"' || v
    || '","baseScore":' || CAST(l_quantity / 5 AS VARCHAR) || ',"impactScore":'
    || CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) || ',"exploitabilityScore":'
    || CAST(l_linenumber / 2 AS VARCHAR)
    || '}},{{"source":"cna","type":"Secondary","version":"3.0","vectorString":"AV:L","baseScore":'
    || CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) || '}}]' END AS "cvssData",
  CASE WHEN l_linenumber > 2 THEN {_SHIFTED_SQL} ELSE '' END AS "dateReserved",
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || ' UTC' AS "dateUpdated",
  '' AS "datePublic", {_SHIFTED_SQL} AS "lastModified",
  CAST(year(l_shipdate) AS INTEGER) AS year_published, CAST(l_shipdate AS DATE) AS date_published
FROM r""")
def lookup_view(spark, sf_dir):
    return lookup.lookup_projection(current_rows(spark, sf_dir))
