"""JSON, array, map and struct operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested, scoring
from ..operators import feeds, mapping
from ..schemas import SCORE_FIELDS
from . import query
from .tables import read

_SIX_NULL = {f: "string" for f in ("source", "type", "vectorString")} | {
    f: "double" for f in ("impactScore", "exploitabilityScore")}


def _entry(ver, base):
    """A score entry with only a version and a base score."""
    return F.struct(*[
        (F.lit(None).cast(_SIX_NULL[f]) if f in _SIX_NULL
         else (F.lit(ver) if f == "version" else base.cast("double"))).alias(f)
        for f in SCORE_FIELDS])


def _bases(arr):
    return F.array_join(F.transform(arr, lambda s: F.concat_ws(
        ":", s["version"], s["baseScore"].cast("string"))), ",")


@query("json_parse", """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""")
def json_parse(spark, sf_dir):
    pairs = read(spark, sf_dir, "events").select(
        F.array(F.array(F.col("event_id").cast("string"), "props")).alias("pairs"))
    return feeds.parse_pairs(pairs, "pairs", "k bigint", "id").select("id", "details.k")


@query("lang_filter", """
SELECT doc_id, CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS n_english,
  CASE WHEN lang = 'en' THEN md5(text) ELSE md5(source) END AS first_english
FROM documents""")
def lang_filter(spark, sf_dir):
    said = lambda lang, value: F.struct(lang.alias("lang"), F.col(value).alias("value"))
    arr = F.array(said(F.lit("es"), "source"), said(F.col("lang"), "text"),
                  said(F.lit("en-GB"), "source"))
    return read(spark, sf_dir, "documents").select(
        "doc_id", F.size(nested.english_only(arr)).alias("n_english"),
        F.md5(nested.first_english(arr)).alias("first_english"))


@query("nested_filter", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN '' ELSE 'CWE-' || l_linenumber END
    || CASE WHEN l_linestatus = 'F' AND NOT (l_linenumber = 7 AND l_returnflag <> 'N')
            THEN CASE WHEN l_returnflag = 'N' THEN '' ELSE ',' END || 'CWE-7' ELSE '' END AS cwe,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE 'CAPEC-' || l_linenumber || '=' || l_linestatus END AS capec,
  'CWE-' || l_suppkey AS nvd_cwe
FROM lineitem""")
def nested_filter(spark, sf_dir):
    line, flag = F.col("l_linenumber").cast("string"), F.col("l_returnflag")
    cwe = F.concat(F.lit("CWE-"), line)
    described = lambda kind, lang, ident: F.struct(
        kind.alias("type"), ident.alias("cweId"), lang.alias("lang"), F.lit("d").alias("description"))
    problems = lambda *d: F.array(F.struct(F.array(*d).alias("descriptions")))
    own = problems(
        described(F.lit("CWE"), F.when(flag == "N", "es").otherwise("en"), cwe),
        described(F.lit("text"), F.lit("en"), cwe),
        described(F.lit("CWE"), F.lit("en-US"), F.lit(None).cast("string")))
    adp = F.when(F.col("l_linestatus") == "F", F.array(F.struct(
        problems(described(F.lit("CWE"), F.lit("en"), F.lit("CWE-7"))).alias("problemTypes"))))
    said = lambda lang, value: F.struct(F.lit(lang).alias("lang"), value.alias("value"))
    impacts = F.array(F.struct(
        F.when(flag != "R", F.concat(F.lit("CAPEC-"), line)).alias("capecId"),
        F.array(said("en", F.col("l_linestatus")), said("de", flag)).alias("descriptions")))
    weaknesses = F.array(F.struct(F.array(
        said("en", F.concat(F.lit("CWE-"), F.col("l_suppkey").cast("string"))),
        said("en", F.lit("NVD-noinfo")), said("es", cwe)).alias("description")))
    found = nested.cwe_from_problem_types(own, adp)
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.array_join(F.transform(found, lambda x: x["cweId"]), ",").alias("cwe"),
        F.array_join(F.transform(nested.capec_from_impacts(impacts), lambda x: F.concat_ws(
            "=", x["capecId"], x["capecDescription"])), ",").alias("capec"),
        F.array_join(F.transform(nested.cwe_from_weaknesses(weaknesses),
                                 lambda x: x["cweId"]), ",").alias("nvd_cwe"))


@query("explode_outer", """
WITH a AS (
  SELECT o_orderstatus AS vendor, o_orderpriority AS product, o_orderkey FROM orders
    WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT 'all' AS vendor, CAST(NULL AS VARCHAR) AS product, o_orderkey FROM orders
    WHERE o_orderstatus <> 'P')
SELECT vendor, product, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM a GROUP BY ALL""")
def explode_outer(spark, sf_dir):
    entry = lambda vendor, product: F.struct(vendor.alias("vendor"), product.alias("product"))
    affected = F.when(F.col("o_orderstatus") != "P", F.array(
        entry(F.col("o_orderstatus"), F.col("o_orderpriority")),
        entry(F.lit("all"), F.lit(None).cast("string"))))
    docs = read(spark, sf_dir, "orders").select(
        F.struct(F.col("o_orderkey").alias("cveId")).alias("cveMetadata"),
        F.struct(F.struct(affected.alias("affected")).alias("cna")).alias("containers"))
    return mapping.affected_pairs(docs).groupBy("vendor", "product").agg(
        F.count("*").alias("n"), F.sum("cve").alias("ids"))


@query("coalesce_struct", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN '3.0:' || CAST(l_tax + 1 AS VARCHAR)
       WHEN l_linestatus = 'F' THEN '3.1:' || CAST(l_quantity / 5 AS VARCHAR)
       ELSE '3.1:' || CAST(l_quantity / 5 AS VARCHAR) || ',3.0:' || CAST(l_tax + 1 AS VARCHAR)
  END AS scores
FROM lineitem""")
def coalesce_struct(spark, sf_dir):
    block = lambda ver, base: F.struct(
        F.lit(ver).alias("version"), F.lit("AV:N").alias("vectorString"), base.alias("baseScore"))
    metric = lambda v31: F.struct(v31.alias("cvssV3_1"))
    own = block("3.1", F.col("l_quantity") / 5)
    second = F.when(F.col("l_linestatus") == "F", own)
    cna = F.when(F.col("l_returnflag") != "N", F.array(metric(own), metric(second)))
    adp = F.array(F.struct(F.array(metric(block("3.0", F.col("l_tax") + 1))).alias("metrics")))
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", _bases(nested.alt_cvss(cna, adp)).alias("scores"))


@query("argmax_in_array", """
WITH e AS (SELECT l_orderkey, l_linenumber, l_quantity / 5 AS a,
    CASE WHEN l_tax < 0.08 THEN CAST(l_linenumber AS DOUBLE) END AS b,
    abs(round(l_discount * 100)) AS c, l_returnflag FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE greatest(a, b, c) END AS score,
  CASE WHEN l_returnflag = 'N' THEN '' WHEN a = greatest(a, b, c) THEN 'a'
       WHEN b = greatest(a, b, c) THEN 'b' ELSE 'c' END AS version
FROM e""")
def argmax_in_array(spark, sf_dir):
    entries = F.array(
        _entry("a", F.col("l_quantity") / 5),
        _entry("b", F.when(F.col("l_tax") < 0.08, F.col("l_linenumber"))),
        _entry("c", F.abs(F.round(F.col("l_discount") * 100))))
    best = scoring.best_entry(F.when(F.col("l_returnflag") != "N", entries))
    return (read(spark, sf_dir, "lineitem")
            .select("l_orderkey", "l_linenumber", best.alias("best"))
            .select("l_orderkey", "l_linenumber", F.col("best.baseScore").alias("score"),
                    "best.version"))


@query("array_join", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'CWE-' || p_size END || ', ' || p_brand
  AS labels FROM part""")
def array_join(spark, sf_dir):
    label = lambda ident, text: F.struct(ident.alias("cweId"), text.alias("cweDescription"))
    arr = F.array(
        label(F.concat(F.lit("CWE-"), F.col("p_size").cast("string")),
              F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(" ")),
        label(F.col("p_brand"), F.lit(None).cast("string")))
    return read(spark, sf_dir, "part").select(
        "p_partkey", nested.label_list(arr, "cweDescription", "cweId").alias("labels"))


@query("struct_reorder", """
SELECT c_custkey, '[{"name":"' || c_name || '","segment":"' || c_mktsegment || '","nation":'
  || c_nationkey || '}]' AS ordered FROM customer""")
def struct_reorder(spark, sf_dir):
    arr = F.array(F.struct(F.col("c_nationkey").alias("nation"),
                           F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name")))
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.to_json(nested.order_struct_fields(arr, ["name", "segment", "nation"])).alias("ordered"))


@query("empty_to_null", """
SELECT doc_id, lang <> 'en' AS missing, CASE WHEN lang = 'en' THEN source END AS first_item
FROM documents""")
def empty_to_null(spark, sf_dir):
    arr = nested.empty_to_null(F.filter(
        F.array("source", F.lit(None)), lambda x: (F.col("lang") == "en") & x.isNotNull()))
    return read(spark, sf_dir, "documents").select(
        "doc_id", arr.isNull().alias("missing"), F.get(arr, F.lit(0)).alias("first_item"))


def _metric_map():
    fields = lambda ver, base: F.struct(
        F.lit("s").alias("source"), F.lit("t").alias("type"),
        F.struct(F.lit(ver).alias("version"), F.lit("AV:N").alias("vectorString"),
                 base.alias("baseScore")).alias("cvssData"),
        F.lit(1.0).alias("exploitabilityScore"), F.lit(2.0).alias("impactScore"))
    line = F.col("l_linenumber").cast("double")
    return F.create_map(
        F.lit("cvssMetricV31"), F.array(fields("3.1", F.col("l_quantity") / 5), fields("3.1", line)),
        F.when(F.col("l_returnflag") == "N", "vendorMetric").otherwise("cvssMetricV2"),
        F.when(F.col("l_returnflag") != "A", F.array(fields("2.0", line))))


@query("map_flatten", """
SELECT l_orderkey, l_linenumber, '3.1:' || CAST(l_quantity / 5 AS VARCHAR)
  || CASE WHEN l_quantity / 5 = l_linenumber THEN '' ELSE ',3.1:' || CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) END
  || CASE WHEN l_returnflag = 'A' THEN '' ELSE ',2.0:' || CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) END
  AS scores
FROM lineitem""")
def map_flatten(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        _bases(nested.cvss_from_metric_map(_metric_map())).alias("scores"))


@query("map_keys", """
SELECT 'cvssMetricV31' AS version WHERE EXISTS (SELECT 1 FROM lineitem)
UNION SELECT CASE WHEN l_returnflag = 'N' THEN 'vendorMetric' ELSE 'cvssMetricV2' END FROM lineitem""")
def map_keys(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(_metric_map().alias("metrics"))
    return feeds.map_key_list(rows, "metrics", "version")


@query("collect_flat", """
WITH tags AS (SELECT p_brand, unnest([l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR)]) AS t
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT p_brand, string_agg(t, ',' ORDER BY t) AS tags FROM (SELECT DISTINCT p_brand, t FROM tags)
GROUP BY p_brand""")
def collect_flat(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = read(spark, sf_dir, "lineitem")
    tags = F.array("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    return (rows.join(part, rows.l_partkey == part.p_partkey).select("p_brand", tags.alias("tags"))
            .groupBy("p_brand").agg(nested.collect_distinct_flat(F.col("tags")).alias("tags"))
            .select("p_brand", F.array_join(F.array_sort("tags"), ",").alias("tags")))


@query("two_phase_collect", """
WITH d AS (SELECT l_suppkey, 'CWE-' || l_linenumber AS id, max(l_returnflag) AS label
  FROM lineitem GROUP BY ALL)
SELECT l_suppkey, string_agg(id || '=' || label, ',' ORDER BY id) AS cwe FROM d GROUP BY l_suppkey""")
def two_phase_collect(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.concat(F.lit("CWE-"), F.col("l_linenumber").cast("string")).alias("cweId"),
        F.col("l_returnflag").alias("cweDescription"))
    joined = lambda x: F.concat_ws("=", x["cweId"], x["cweDescription"])
    return feeds.dedupe_then_collect(rows, ["l_suppkey"]).select(
        "l_suppkey", F.array_join(F.transform("cweData", joined), ",").alias("cwe"))


@query("collapse_rows", """
WITH first_rows AS (
  SELECT l_suppkey, l_returnflag, l_quantity FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_suppkey
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity) = 1),
tags AS (SELECT l_suppkey, string_agg(t, ',' ORDER BY t) AS tags FROM (
  SELECT DISTINCT l_suppkey, unnest([l_linestatus, CAST(l_linenumber AS VARCHAR)]) AS t FROM lineitem)
  GROUP BY l_suppkey)
SELECT l_suppkey, l_returnflag, l_quantity, tags FROM first_rows JOIN tags USING (l_suppkey)""")
def collapse_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumn(
        "tags", F.array("l_linestatus", F.col("l_linenumber").cast("string")))
    merged = feeds.collapse_chunks(
        rows, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
        ["l_returnflag", "l_quantity"], ["tags"])
    return merged.withColumn("tags", F.array_join(F.array_sort("tags"), ","))
