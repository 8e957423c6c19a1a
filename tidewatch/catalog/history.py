"""Merges, slowly changing history and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history, joins
from ..plans import master
from ..schemas import KEYS
from ..session import cut_lineage, workspace
from . import query
from .tables import ntz, read

_SEGMENT = {"vendor": "c_mktsegment", "product": "CAST(c_nationkey AS VARCHAR)"}


def _days_after(start, column, modulus):
    return F.expr(f"TIMESTAMP_NTZ '{start}' + make_dt_interval({column} % {modulus})")


def target_rows(spark, sf_dir):
    """A history: one row per customer, every sixth one closed."""
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("vendor"), F.col("c_nationkey").cast("string").alias("product"),
        key.cast("string").alias("cveId"),
        F.when(key % 4 != 0, _days_after("2024-01-01 00:00:00", "c_custkey", 10)).alias("lastModified"),
        F.col("c_acctbal").alias("score"), ntz("2023-01-01").alias("validFrom"),
        F.when(key % 6 == 0, ntz("2023-06-01")).alias("validTo"),
        (key % 6 != 0).alias("currentFlag"))


def batch_rows(spark, sf_dir):
    """A batch: one row per order for its customer, every seventh for an unknown one."""
    customer = read(spark, sf_dir, "customer")
    orders = read(spark, sf_dir, "orders")
    key = F.col("c_custkey") + F.when(F.col("o_orderkey") % 7 == 0, 1_000_000_000).otherwise(0)
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_mktsegment").alias("vendor"), F.col("c_nationkey").cast("string").alias("product"),
        key.cast("string").alias("cveId"),
        F.when(F.col("o_orderkey") % 5 != 0,
               _days_after("2023-12-25 00:00:00", "o_orderkey", 14)).alias("lastModified"),
        F.col("o_totalprice").alias("score"), ntz("2024-06-01").alias("validFrom"),
        F.lit(None).cast("timestamp_ntz").alias("validTo"), F.lit(True).alias("currentFlag"),
        "o_orderkey")


_TARGET = """
target AS (SELECT c_mktsegment AS vendor, CAST(c_nationkey AS VARCHAR) AS product,
    CAST(c_custkey AS VARCHAR) AS "cveId",
    CASE WHEN c_custkey % 4 <> 0 THEN TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 10 AS INTEGER)) END AS "lastModified",
    c_acctbal AS score, TIMESTAMP '2023-01-01' AS "validFrom",
    CASE WHEN c_custkey % 6 = 0 THEN TIMESTAMP '2023-06-01' END AS "validTo",
    c_custkey % 6 <> 0 AS "currentFlag" FROM customer)"""
_ROWS = """
rows AS (SELECT c_mktsegment AS vendor, CAST(c_nationkey AS VARCHAR) AS product,
    CAST(c_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1000000000 ELSE 0 END AS VARCHAR) AS "cveId",
    CASE WHEN o_orderkey % 5 <> 0 THEN TIMESTAMP '2023-12-25' + to_days(CAST(o_orderkey % 14 AS INTEGER)) END AS "lastModified",
    o_totalprice AS score, TIMESTAMP '2024-06-01' AS "validFrom", CAST(NULL AS TIMESTAMP) AS "validTo",
    TRUE AS "currentFlag", o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
_BATCH = _ROWS + """,
batch AS (SELECT * EXCLUDE (o_orderkey) FROM rows QUALIFY row_number() OVER (
  PARTITION BY vendor, product, "cveId" ORDER BY "lastModified" DESC NULLS LAST, o_orderkey DESC) = 1)"""
_SAME = 't.vendor = s.vendor AND t.product = s.product AND t."cveId" = s."cveId"'


def _expired(hit):
    return f"""
expired AS (SELECT t.* EXCLUDE ("validTo", "currentFlag"),
    CASE WHEN t."currentFlag" AND {hit} THEN s."validFrom" ELSE t."validTo" END AS "validTo",
    t."currentFlag" AND NOT coalesce({hit}, FALSE) AS "currentFlag"
  FROM target t LEFT JOIN batch s ON {_SAME})"""


_LATER = """(s."lastModified" IS NOT NULL AND (t."lastModified" IS NULL OR t."lastModified" < s."lastModified"))"""
_INSERTED = f"""
SELECT * FROM expired UNION ALL BY NAME
SELECT * FROM batch s WHERE NOT EXISTS (SELECT 1 FROM expired t WHERE t."currentFlag" AND {_SAME})"""


def _batch(spark, sf_dir):
    return joins.latest_per_key(batch_rows(spark, sf_dir), KEYS,
                                ["lastModified", "o_orderkey"]).drop("o_orderkey")


@query("scd2_expire", f"WITH {_TARGET}, {_BATCH}, {_expired(_LATER)} SELECT * FROM expired")
def scd2_expire(spark, sf_dir):
    return history.scd2_expire(target_rows(spark, sf_dir), _batch(spark, sf_dir))


@query("scd2_insert", f"""WITH {_TARGET}, {_BATCH}
SELECT * FROM target UNION ALL BY NAME
SELECT * FROM batch s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t."currentFlag" AND {_SAME})""")
def scd2_insert(spark, sf_dir):
    return history.scd2_insert(target_rows(spark, sf_dir), _batch(spark, sf_dir))


@query("scd2_merge", f"WITH {_TARGET}, {_BATCH}, {_expired(_LATER)} {_INSERTED}")
def scd2_merge(spark, sf_dir):
    return history.scd2_merge(target_rows(spark, sf_dir), batch_rows(spark, sf_dir),
                              tie_breakers=["o_orderkey"], cut=cut_lineage)


@query("scd2_current", f"""WITH {_TARGET}
SELECT *, CAST(year("lastModified") AS INTEGER) AS year_published,
  CAST("lastModified" AS DATE) AS date_published FROM target WHERE "currentFlag" """)
def scd2_current(spark, sf_dir):
    return history.read_current(target_rows(spark, sf_dir), "lastModified")


_HASHED = "md5(" + " || ".join(f"coalesce('V' || length({c}) || ':' || {c}, 'N')" for c in (
    "vendor", "CAST(score AS VARCHAR)", "strftime(\"lastModified\", '%Y-%m-%d %H:%M:%S')")) + ")"


@query("scd2_hash", f"""WITH {_TARGET.replace('target AS', 'plain AS')}, {_BATCH.replace('batch AS', 'latest AS')},
target AS (SELECT *, {_HASHED} AS row_hash FROM plain),
batch AS (SELECT *, {_HASHED} AS row_hash FROM latest),
{_expired('t.row_hash <> s.row_hash')} {_INSERTED}""")
def scd2_hash(spark, sf_dir):
    hashed = lambda df: df.withColumn(
        "row_hash", history.row_hash(["vendor", "score", "lastModified"]))
    return history.scd2_by_hash(hashed(target_rows(spark, sf_dir)), hashed(batch_rows(spark, sf_dir)),
                                KEYS, ["lastModified", "o_orderkey"], cut=cut_lineage)


def _in_place(spark, first, batch, ends):
    """``first`` laid out by years on disk, after ``batch``."""
    root = workspace(spark, "history")
    master.start_history(first, root, "lastModified")
    master.apply_batch(spark, root, batch, 1, ends, KEYS, "lastModified")
    return master.read_history(spark, root, first.schema)


_FILED = """SELECT *, CAST(CASE WHEN "currentFlag" THEN 0 WHEN "validTo" = TIMESTAMP '2023-06-01' THEN -1 ELSE 1 END AS INTEGER) AS ended_in,
  CAST(year("lastModified") AS INTEGER) AS year_published FROM"""


@query("scd2_partitioned", f"WITH {_TARGET}, {_BATCH}, {_expired(_LATER)} {_FILED} ({_INSERTED})")
def scd2_partitioned(spark, sf_dir):
    batch = joins.latest_per_key(batch_rows(spark, sf_dir), KEYS, ["lastModified", "o_orderkey"])
    return _in_place(spark, target_rows(spark, sf_dir), batch.drop("o_orderkey"),
                     history.later_modified("lastModified"))


@query("scd2_hash_partitioned", f"""WITH {_TARGET.replace('target AS', 'plain AS')}, {_BATCH.replace('batch AS', 'latest AS')},
target AS (SELECT *, {_HASHED} AS row_hash FROM plain),
batch AS (SELECT *, {_HASHED} AS row_hash FROM latest),
{_expired('t.row_hash <> s.row_hash')} {_FILED} ({_INSERTED})""")
def scd2_hash_partitioned(spark, sf_dir):
    hashed = lambda df: df.withColumn(
        "row_hash", history.row_hash(["vendor", "score", "lastModified"]))
    batch = joins.latest_per_key(batch_rows(spark, sf_dir), KEYS, ["lastModified", "o_orderkey"])
    return _in_place(spark, hashed(target_rows(spark, sf_dir)), hashed(batch).drop("o_orderkey"),
                     history.other_hash)


@query("merge_upsert", f"""WITH {_TARGET}, {_BATCH}
SELECT t.* FROM target t LEFT JOIN batch s ON {_SAME}
WHERE s.vendor IS NULL OR NOT coalesce(t."lastModified" <> s."lastModified", FALSE)
UNION ALL BY NAME
SELECT s.* FROM batch s LEFT JOIN target t ON {_SAME}
WHERE t.vendor IS NULL OR coalesce(t."lastModified" <> s."lastModified", FALSE)""")
def merge_upsert(spark, sf_dir):
    return joins.merge_upsert(target_rows(spark, sf_dir), _batch(spark, sf_dir), KEYS,
                              ["lastModified"])


@query("upsert_by_key", """WITH incoming AS (
  SELECT o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1000000000 ELSE 0 END AS id,
    o_orderpriority AS body, o_orderkey AS seq FROM orders WHERE o_orderstatus <> 'P'),
fresh AS (SELECT * FROM incoming QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
SELECT id, body, seq FROM fresh UNION ALL
SELECT c_custkey, c_name, CAST(-1 AS BIGINT) FROM customer
WHERE c_custkey NOT IN (SELECT id FROM fresh)""")
def upsert_by_key(spark, sf_dir):
    target = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("body"),
        F.lit(-1).cast("bigint").alias("seq"))
    unknown = F.when(F.col("o_orderkey") % 7 == 0, 1_000_000_000).otherwise(0)
    incoming = read(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + unknown).alias("id"), F.col("o_orderpriority").alias("body"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", "{broken").alias("_corrupt_record"))
    return joins.upsert_documents(target, incoming, "id", ["seq"], "_corrupt_record")


@query("anti_delete", """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""")
def anti_delete(spark, sf_dir):
    doomed = (read(spark, sf_dir, "customer").filter("c_acctbal < 0")
              .select(F.col("c_custkey").alias("o_custkey")))
    return joins.delete_where_exists(
        read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), doomed, ["o_custkey"])


_SIDES = """
l AS (SELECT c_custkey + 50 AS id, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS score,
    DATE '1990-01-01' + c_nationkey AS published FROM customer),
r AS (SELECT o_custkey AS id, max(o_orderpriority) AS score, CAST(min(o_orderdate) AS DATE) AS published
  FROM orders GROUP BY o_custkey)"""


@query("full_outer_merge", f"""WITH {_SIDES}
SELECT id, l.name, coalesce(l.published, r.published) AS published, coalesce(r.score, '?') AS description,
  CASE WHEN r.score IS NOT NULL AND r.score <> '1-URGENT' THEN r.score ELSE l.score END AS score
FROM l FULL JOIN r USING (id)""")
def full_outer_merge(spark, sf_dir):
    filled = lambda c, blank: F.when(F.col(c) == blank, F.array().cast("array<string>")
                                     ).otherwise(F.array(c))
    # keys are shifted, so that each side has some that the other lacks
    left = read(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 50).alias("id"), F.col("c_name").alias("name"),
        filled("c_mktsegment", "BUILDING").alias("scores"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_nationkey")).alias("published"))
    right = (read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id"))
             .agg(F.max("o_orderpriority").alias("score"),
                  F.to_date(F.min("o_orderdate")).alias("published"))
             .withColumn("scores", filled("score", "1-URGENT")))
    return joins.full_merge(left, right, ["id"], {
        "name": F.col("l.name"),
        "published": F.coalesce("l.published", "r.published"),
        "description": F.coalesce("r.score", F.lit("?")),
        "score": F.get(joins.prefer_filled("r.scores", "l.scores"), F.lit(0)),
    })


@query("left_join_agg", """
SELECT c_custkey, c_mktsegment, n, last_order FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n, CAST(max(o_orderdate) AS DATE) AS last_order FROM orders
  GROUP BY o_custkey) ON c_custkey = o_custkey""")
def left_join_agg(spark, sf_dir):
    totals = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.to_date(F.max("o_orderdate")).alias("last_order"))
    return joins.attach(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
                        totals, ["c_custkey"])


@query("prefer_source", """
SELECT doc_id, CASE WHEN d.doc_id IS NOT NULL THEN lang ELSE 'label' END AS kind,
  CASE WHEN d.doc_id IS NOT NULL THEN n_chars ELSE quality END AS amount
FROM (SELECT * REPLACE (doc_id + 100 AS doc_id) FROM documents) d FULL JOIN labels USING (doc_id)""")
def prefer_source(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 100).alias("doc_id"), F.col("lang").alias("kind"), F.col("n_chars").alias("amount"))
    labels = read(spark, sf_dir, "labels").select(
        "doc_id", F.lit("label").alias("kind"), F.col("quality").cast("bigint").alias("amount"))
    return joins.first_available(docs, labels, "doc_id")


@query("distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus,
  concat('a=', l_linenumber, ',b=', CAST(l_quantity AS INTEGER) % 3) AS entries FROM lineitem""")
def distinct_rows(spark, sf_dir):
    number = lambda c: c.cast("string")
    line, rest = number(F.col("l_linenumber")), number(F.col("l_quantity").cast("int") % 3)
    ordered = F.create_map(F.lit("a"), line, F.lit("b"), rest)
    swapped = F.create_map(F.lit("b"), rest, F.lit("a"), line)
    rows = read(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.when(F.col("l_tax") > 0.04, ordered).otherwise(swapped).alias("m"))
    entries = F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return joins.distinct_rows(rows).select(
        "l_returnflag", "l_linestatus", F.array_join(entries, ",").alias("entries"))
