"""Id sets, snapshots, change feed and the cpe hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mapping as ops
from . import query
from .tables import lineitem, ntz, read

_RUN = "2025-05-03T10:11:12+00:00"


def raw_pairs(spark, sf_dir):
    """(vendor, product, cve) with spellings that clean to one key, and some unnamed vendors."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = lineitem(spark, sf_dir)
    line = F.col("l_linenumber")
    vendor = (F.when(line == 1, F.concat(F.lit(" "), F.upper("p_brand"), F.lit("\t")))
              .when(line == 2, "N/A").when(line == 3, "*** n/a ***").otherwise(F.col("p_brand")))
    return rows.join(part, rows.l_partkey == part.p_partkey).select(
        vendor.alias("vendor"), F.col("l_partkey").cast("string").alias("product"),
        F.col("l_orderkey").alias("cve"), "l_shipdate", "l_returnflag")


_PAIRS = """
pairs AS (SELECT DISTINCT lower(p_brand) AS vendor, CAST(l_partkey AS VARCHAR) AS product,
    l_orderkey AS cve, l_shipdate < TIMESTAMP '2001-05-01' AS in_old, l_shipdate >= TIMESTAMP '1995-03-01' AS in_new,
    l_returnflag <> 'N' AS nvd
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber NOT IN (2, 3))"""


def _side(spark, sf_dir, feed, when, at, tasks=None):
    rows = raw_pairs(spark, sf_dir).filter(when)
    if feed:
        rows = rows.filter(F.col("l_returnflag") != "N" if feed == "nvd"
                           else F.col("l_returnflag") == "N")
    return ops.id_pairs(rows.select("vendor", "product", "cve"), ntz(at), tasks=tasks)


_OLD = "l_shipdate < TIMESTAMP_NTZ '2001-05-01'"
_NEW = "l_shipdate >= TIMESTAMP_NTZ '1995-03-01'"


def old_side(spark, sf_dir, feed=None, tasks=None):
    return _side(spark, sf_dir, feed, _OLD, "2025-05-01", tasks)


def new_side(spark, sf_dir, feed=None, tasks=None):
    return _side(spark, sf_dir, feed, _NEW, "2025-05-03", tasks)


def all_pairs(spark, sf_dir):
    return _side(spark, sf_dir, None, F.lit(True), "2025-05-03")


@query("id_sets", f"""WITH {_PAIRS}
SELECT vendor, product, count(DISTINCT cve) AS n, min(cve) AS first_cve, max(cve) AS last_cve,
  CAST(sum(DISTINCT cve) AS BIGINT) AS ids FROM pairs GROUP BY vendor, product""")
def id_sets(spark, sf_dir):
    return all_pairs(spark, sf_dir).groupBy("vendor", "product").agg(
        F.count("*").alias("n"), F.min("cve").alias("first_cve"), F.max("cve").alias("last_cve"),
        F.sum("cve").alias("ids"))


@query("id_set_chunks", f"""WITH {_PAIRS}
SELECT vendor, product, count(DISTINCT cve) AS n, CAST(sum(DISTINCT cve) AS BIGINT) AS ids
FROM pairs GROUP BY vendor, product""")
def id_set_chunks(spark, sf_dir):
    packed = ops.pack_id_sets(all_pairs(spark, sf_dir), per_row=8)
    total = F.aggregate("cves", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return packed.groupBy("vendor", "product").agg(
        F.sum(F.size("cves")).alias("n"), F.sum(total).alias("ids"))


def _in_order(packed, ids):
    return packed.select("vendor", "product", "chunk", F.array_join(ids, ",").alias("ids"))


@query("id_set_order", f"""WITH {_PAIRS}, n AS (SELECT vendor, product, cve,
    (row_number() OVER (PARTITION BY vendor, product ORDER BY cve) - 1) // 8 AS chunk
  FROM (SELECT DISTINCT vendor, product, cve FROM pairs))
SELECT vendor, product, chunk, string_agg(cve::VARCHAR, ',' ORDER BY cve) AS ids FROM n GROUP BY ALL""")
def id_set_order(spark, sf_dir):
    packed = ops.pack_id_sets(all_pairs(spark, sf_dir), per_row=8)
    return _in_order(packed, F.col("cves").cast("array<string>"))


@query("pair_document_order", f"""WITH {_PAIRS}, n AS (SELECT vendor, product, cve, o_orderpriority AS body,
    coalesce(sum(length(cve::VARCHAR) + length(o_orderpriority)) OVER (PARTITION BY vendor, product ORDER BY cve
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 100 AS chunk
  FROM (SELECT DISTINCT vendor, product, cve FROM pairs) JOIN orders ON cve = o_orderkey WHERE o_orderstatus <> 'P')
SELECT vendor, product, chunk::BIGINT AS chunk, string_agg(cve || '=' || body, ',' ORDER BY cve) AS ids FROM n GROUP BY ALL""")
def pair_document_order(spark, sf_dir):
    """The documents of each key in order, chunk by chunk of at most 200 bytes."""
    docs = read(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("cve"), F.col("o_orderpriority").alias("document"))
    sets = ops.pack_by_bytes(all_pairs(spark, sf_dir), docs, max_bytes=200)
    paired = ops.pair_documents(sets, docs)
    return _in_order(paired, F.transform("pairs", lambda p: F.concat(p[0], F.lit("="), p[1])))


_DIFF = """
SELECT vendor, product, count(*) FILTER (n AND NOT o) AS added, count(*) FILTER (o AND NOT n) AS removed
FROM (SELECT vendor, product, cve, bool_or(in_old) AS o, bool_or(in_new) AS n FROM pairs {where}
      GROUP BY ALL) WHERE o <> n GROUP BY vendor, product"""


@query("snapshot_diff", f"WITH {_PAIRS} {_DIFF.format(where='')}")
def snapshot_diff(spark, sf_dir):
    tasks = ops.tasks_for(raw_pairs(spark, sf_dir))
    return ops.snapshot_diff(new_side(spark, sf_dir, tasks=tasks), old_side(spark, sf_dir, tasks=tasks))


@query("snapshot_rows", f"""WITH {_PAIRS}
SELECT DISTINCT vendor, product, cve, TIMESTAMP '2025-05-03' AS build_ts FROM pairs WHERE in_new""")
def snapshot_rows(spark, sf_dir):
    both = old_side(spark, sf_dir).unionByName(new_side(spark, sf_dir))
    builds = ops.build_meta(both, "nvd_ts")
    return ops.snapshot(both, ops.newest_build(builds, "nvd_ts"))


_CHANGED = "SELECT o_orderkey FROM orders WHERE o_totalprice > 495000"


def changed_ids(spark, sf_dir):
    docs = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("cve"), F.col("o_totalprice").alias("lastModifiedDate"),
        F.lit(None).cast("double").alias("publishedDate"))
    return ops.metadata_changed(docs, F.lit(495000.0), ["lastModifiedDate", "publishedDate"])


@query("semi_touching", f"""WITH {_PAIRS}
SELECT DISTINCT vendor, product FROM pairs WHERE cve IN ({_CHANGED})""")
def semi_touching(spark, sf_dir):
    return ops.touching(all_pairs(spark, sf_dir), changed_ids(spark, sf_dir))


@query("change_feed", f"""WITH {_PAIRS}, keys AS (
  SELECT vendor, product FROM ({_DIFF.format(where='WHERE nvd')})
  UNION SELECT vendor, product FROM ({_DIFF.format(where='WHERE NOT nvd')})
  UNION SELECT vendor, product FROM pairs WHERE in_new AND cve IN ({_CHANGED}))
SELECT sha256('["' || vendor || '","' || product || '","{_RUN}"]') AS message_id,
  regexp_replace(vendor || '_' || product, '[^A-Za-z0-9_-]', '_', 'g') AS label,
  '{{"vendor":"' || vendor || '","product":"' || product || '","ingestionTimestamp":"{_RUN}"}}' AS body
FROM keys""")
def change_feed(spark, sf_dir):
    """Both feeds at once: each build is read once, whatever the number of feeds."""
    tasks = ops.tasks_for(raw_pairs(spark, sf_dir))

    def side(when, at):
        rows = raw_pairs(spark, sf_dir).filter(when)
        tagged = rows.select("vendor", "product", "cve", (F.col("l_returnflag") != "N").alias("feed"))
        return ops.id_pairs(tagged, ntz(at), ["feed"], tasks)

    keys = ops.changed_keys(side(_NEW, "2025-05-03"), side(_OLD, "2025-05-01"),
                            changed_ids(spark, sf_dir), ["feed"])
    return ops.change_feed([keys], _RUN)


@query("build_meta", f"""WITH {_PAIRS}
SELECT 'nvd_ts' AS collection, TIMESTAMP '2025-05-03' AS ts, count(DISTINCT (vendor, product)) AS count
FROM pairs WHERE in_new""")
def build_meta(spark, sf_dir):
    old, new = old_side(spark, sf_dir), new_side(spark, sf_dir)
    known = ops.build_meta(old, "nvd_ts")
    return ops.build_meta(old.unionByName(new), "nvd_ts", known)


@query("browse_distinct", f"""WITH {_PAIRS}
SELECT 'vendor' AS kind, vendor AS name FROM pairs WHERE in_old OR in_new
UNION SELECT 'product', product FROM pairs WHERE (in_old OR in_new) AND vendor = 'brand#7'""")
def browse_distinct(spark, sf_dir):
    return ops.browse_lists("brand#7", old_side(spark, sf_dir), new_side(spark, sf_dir))


@query("baseline_build", """
WITH meta AS (SELECT event_type AS collection, ts FROM events)
SELECT collection, max(ts) AS newest,
  coalesce(max(ts) FILTER (ts <= TIMESTAMP '2024-01-28 00:00:00' - INTERVAL 72 HOUR), min(ts)) AS baseline
FROM meta WHERE collection IN ('click', 'view') GROUP BY collection
UNION ALL
SELECT collection, max(ts), coalesce(max(ts) FILTER (ts <= TIMESTAMP '2020-01-01'), min(ts))
FROM meta WHERE collection = 'error' GROUP BY collection""")
def baseline_build(spark, sf_dir):
    meta = read(spark, sf_dir, "events").select(F.col("event_type").alias("collection"), "ts")
    def builds(name, now, hours):
        newest = ops.newest_build(meta, name).withColumnRenamed("ts", "newest")
        base = ops.baseline_build(meta, name, ntz(now), hours).withColumnRenamed("ts", "baseline")
        # both sides are one-row aggregates
        return newest.select(F.lit(name).alias("collection"), "newest",
                             base.scalar().alias("baseline"))
    return (builds("click", "2024-01-28", 72).unionByName(builds("view", "2024-01-28", 72))
            .unionByName(builds("error", "2020-01-01", 0)))


@query("batch_ids", """
WITH n AS (SELECT event_id // 500 AS bucket, event_id,
    (row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id) - 1) // 10 AS batch FROM events)
SELECT bucket, batch, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM n GROUP BY bucket, batch""")
def batch_ids(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id")
    batched = ops.batches_of(rows, 10, F.floor(F.col("event_id") / 500), ["event_id"])
    return batched.groupBy("bucket", "batch").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"))


@query("full_batches", """
WITH n AS (SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 10 AS batch FROM events)
SELECT batch, count(*) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS ids FROM n GROUP BY batch""")
def full_batches(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", "ts")
    batched = ops.full_batches(rows, 10, ["ts", "event_id"])
    return batched.groupBy("batch").agg(
        F.count("*").alias("n"),
        F.array_join(F.sort_array(F.collect_list("event_id")).cast("array<string>"), ",").alias("ids"))


@query("hierarchy_sets", r"""
WITH c AS (SELECT CASE p_size % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'o' ELSE 'h' END AS kind,
    CASE WHEN p_size % 4 = 0 THEN 'x\:' ELSE '' END || lower(p_brand) AS vendor,
    lower(p_name) || CASE WHEN p_size % 5 = 0 THEN '\:y' ELSE '' END AS product,
    p_size || ':*:*' AS suffix FROM part)
SELECT 'prefix:cpe' AS set_key, kind AS member FROM c UNION SELECT kind, vendor FROM c
UNION SELECT 'v:' || vendor, product FROM c UNION SELECT 'p:' || product, suffix FROM c""")
def hierarchy_sets(spark, sf_dir):
    kind = F.element_at(F.array(F.lit("a"), F.lit("o"), F.lit("h")), F.col("p_size") % 3 + 1)
    names = read(spark, sf_dir, "part").select(F.concat_ws(
        ":", F.lit("cpe:2.3"), kind,
        F.concat(F.when(F.col("p_size") % 4 == 0, "x\\:").otherwise(""), F.lower("p_brand")),
        F.concat(F.lower("p_name"), F.when(F.col("p_size") % 5 == 0, "\\:y").otherwise("")),
        F.col("p_size").cast("string"), F.lit("*:*")).alias("cpeName"))
    return ops.cpe_hierarchy(names)


@query("cpe_pairs", """
SELECT lower(p_brand) AS vendor, lower(p_type) AS product, p_partkey AS cve FROM part
UNION ALL SELECT 'other', CAST(NULL AS VARCHAR), p_partkey FROM part WHERE p_size % 2 = 0""")
def cpe_pairs(spark, sf_dir):
    match = lambda c: F.struct(c.alias("criteria"))
    node = lambda *m: F.struct(F.array(*m).alias("cpeMatch"))
    full = F.concat_ws(":", F.lit("cpe:2.3:a"), F.lower("p_brand"), F.lower("p_type"), F.lit("1"))
    nodes = F.when(F.col("p_size") % 2 == 0,
                   F.array(node(match(full)), node(match(F.lit("cpe:2.3:a:other"))))
                   ).otherwise(F.array(node(match(full))))
    docs = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.array(F.struct(nodes.alias("nodes")),
                F.struct(F.lit(None).cast("array<struct<cpeMatch: array<struct<criteria: string>>>>")
                         .alias("nodes"))).alias("configurations"))
    return ops.cpe_pairs(docs)


@query("pair_documents", f"""WITH {_PAIRS}
SELECT vendor, product, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids,
  CAST(sum(length(o_orderpriority)) AS BIGINT) AS body_chars
FROM (SELECT DISTINCT vendor, product, cve FROM pairs)
JOIN orders ON cve = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY vendor, product""")
def pair_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("cve"), F.col("o_orderpriority").alias("document"))
    paired = ops.pair_documents(ops.pack_id_sets(all_pairs(spark, sf_dir), per_row=8), docs)
    zero = F.lit(0).cast("bigint")
    ids = F.aggregate("pairs", zero, lambda a, p: a + p[0].cast("bigint"))
    chars = F.aggregate("pairs", zero, lambda a, p: a + F.length(p[1]))
    return paired.groupBy("vendor", "product").agg(
        F.sum(F.size("pairs")).alias("n"), F.sum(ids).alias("ids"), F.sum(chars).alias("body_chars"))


@query("fetch_by_ids", f"""WITH {_PAIRS}
SELECT vendor, product, cve, o_orderstatus, o_totalprice
FROM (SELECT DISTINCT vendor, product, cve FROM pairs) JOIN orders ON cve = o_orderkey""")
def fetch_by_ids(spark, sf_dir):
    docs = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("cve"), "o_orderstatus", "o_totalprice")
    return ops.fetch_by_ids(all_pairs(spark, sf_dir).drop("build_ts"), docs)
