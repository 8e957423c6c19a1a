"""Sources and sinks: each query writes to the shared folder and reads back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..operators import feeds, joins, quality
from ..plans import staging
from ..session import workspace
from ..sources import raw, tables
from . import query
from .tables import read


@query("json_roundtrip", """
SELECT doc_id, lang, source, n_chars, md5(text) AS body FROM documents""")
def json_roundtrip(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    path = workspace(spark, "ndjson")
    tables.compact_json(docs, path, shards=4, compression="gzip")
    back = spark.read.schema(docs.schema).json(path)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("body"))


@query("read_json_typed", """
SELECT event_id, event_type AS vendor, CAST(user_id AS VARCHAR) AS product,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(ts AS DATE) AS "ingestionDate",
  epoch_us(CASE WHEN event_type = 'error' THEN date_trunc('second', ts) ELSE ts END) AS pulled_at
FROM events WHERE value > 1""")
def read_json_typed(spark, sf_dir):
    """Records with the pair's document as a nested object, as the feed writes them."""
    events = read(spark, sf_dir, "events")
    stamp = lambda fmt: F.concat(F.date_format("ts", fmt), F.lit("+00:00"))
    # pairs mix a string and an object, which no array type holds: put together as text
    line = F.format_string(
        '{"ingestionDate":"%s","ingestionTimestamp":"%s","vendor":"%s","product":"%s",'
        '"cveDataAvailable":%s,"cvelistv5":[["%s",%s]],"fkie_nvd":[]}',
        F.date_format("ts", "yyyy-MM-dd"),
        F.when(F.col("event_type") == "error", stamp("yyyy-MM-dd'T'HH:mm:ss"))
         .otherwise(stamp("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        "event_type", F.col("user_id").cast("string"), (F.col("value") > 1).cast("string"),
        F.col("event_id").cast("string"), "props")
    path = workspace(spark, "raw")
    events.select(line.alias("value")).write.option("compression", "gzip").text(path)
    records = feeds.available_only(raw.read_raw(spark, path)).select(
        "vendor", "product", "ingestionDate", "ingestionTimestamp", "cvelistv5")
    return feeds.parse_pairs(records, "cvelistv5", "k bigint", "id").select(
        F.col("id").cast("bigint").alias("event_id"), "vendor", "product", "details.k",
        "ingestionDate", F.unix_micros("ingestionTimestamp").alias("pulled_at"))


@query("dynamic_overwrite", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_published,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
       THEN 'new' ELSE o_orderstatus END AS status FROM orders
WHERE NOT (o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AND o_orderstatus = 'P')""")
def dynamic_overwrite(spark, sf_dir):
    path = workspace(spark, "overwrite")
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").alias("year_published"))
    tables.overwrite_table(rows, path, ["year_published"])
    changed = rows.filter("year_published = 1998 AND status <> 'P'")
    tables.overwrite_table(changed.withColumn("status", F.lit("new")), path, ["year_published"],
                           dynamic=True)
    return spark.read.parquet(path)


@query("compact_files", """
SELECT doc_id, lang, source, n_chars, md5(text) AS body FROM documents""")
def compact_files(spark, sf_dir):
    """Sixty small files of documents, packed into a few by their size."""
    docs = read(spark, sf_dir, "documents")
    small, packed = workspace(spark, "small"), workspace(spark, "packed")
    tables.compact_json(docs, small, shards=60)
    tables.compact_files(spark, small, packed, shard_bytes=1 << 20, compression="gzip")
    back = spark.read.schema(docs.schema).json(packed)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("body"))


@query("publish_partitions", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_published,
  CASE WHEN year(o_orderdate) = 1998 THEN 'new' ELSE o_orderstatus END AS status FROM orders
WHERE year(o_orderdate) <> 1996 AND NOT (year(o_orderdate) = 1998 AND o_orderstatus = 'P')""")
def publish_partitions(spark, sf_dir):
    """One year is replaced and one goes, each at once for who reads the table."""
    name, root = f"published_{uuid4().hex}", workspace(spark, "published")
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").alias("year_published"))
    parts = ["year_published"]
    tables.publish_partitions(rows, name, parts, root, "1", rows.select(*parts).distinct())
    changed = rows.filter("year_published = 1998 AND status <> 'P'").withColumn("status", F.lit("new"))
    touched = spark.createDataFrame([(1996,), (1998,)], "year_published int")
    for _ in range(2):  # a run can be repeated
        tables.publish_partitions(changed, name, parts, root, "2", touched)
    return spark.table(name)


@query("staging_counts", """
SELECT 'read' AS stage, count(*) AS records FROM events
UNION ALL SELECT 'available', count(*) FILTER (value > 1) FROM events""")
def staging_counts(spark, sf_dir):
    """What the staging job has stored about its first stages."""
    events = read(spark, sf_dir, "events")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    record = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("ingestionDate"), stamp.alias("ingestionTimestamp"),
        F.col("event_type").alias("vendor"), F.col("user_id").cast("string").alias("product"),
        (F.col("value") > 1).alias("cveDataAvailable"),
        F.array(F.array(F.concat(F.lit("CVE-"), F.col("event_id").cast("string")), "props")).alias("cvelistv5")))
    path, name = workspace(spark, "raw"), uuid4().hex
    events.select(record.alias("value")).write.text(path)
    staging.stage_day(spark, path, f"staged_{name}", counts=f"counts_{name}")
    return spark.table(f"counts_{name}").filter("position < 2").select("stage", "records")


@query("append_table", """
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events""")
def append_table(spark, sf_dir):
    """Two appends; the first one creates the table."""
    name = f"appended_{uuid4().hex}"
    rows = read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        tables.append_table(rows.filter(part), name, ["event_type"])
    return spark.table(name)


@query("create_table_as", """
SELECT o_custkey, count(*) AS orders, max(o_totalprice) AS highest FROM orders GROUP BY o_custkey""")
def create_table_as(spark, sf_dir):
    name = f"created_{uuid4().hex}"
    tables.create_table_as(read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.max("o_totalprice").alias("highest")), name)
    return spark.table(name)


@query("stage_counts", """
SELECT count(*) AS counted, count(DISTINCT o_custkey) AS customers FROM orders""")
def stage_counts(spark, sf_dir):
    """The number of rows that a write has seen pass, beside what was written."""
    path = workspace(spark, "counted")
    rows, seen = quality.stage_counts(read(spark, sf_dir, "orders"), f"orders-{uuid4().hex}")
    rows.write.parquet(path)
    return spark.read.parquet(path).agg(F.count_distinct("o_custkey").alias("customers")).select(
        F.lit(seen.get["records"]).cast("bigint").alias("counted"), "customers")


@query("yearly_upsert", """
SELECT c_custkey AS id, coalesce(p, c_name) AS body, coalesce(o, -1) AS seq FROM customer LEFT JOIN (
  SELECT o_custkey, o_orderpriority AS p, o_orderkey AS o FROM orders
  WHERE o_orderkey % 5 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) ON c_custkey = o_custkey
UNION ALL SELECT o_custkey, o_orderpriority, o_orderkey FROM orders
WHERE o_orderkey % 5 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def yearly_upsert(spark, sf_dir):
    """Gzip files of documents, one folder a year, with lines that break off."""
    root = workspace(spark, "yearly")
    line = F.to_json(F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("body"),
                              F.col("o_orderkey").alias("seq")))
    broken = F.col("o_orderkey") % 5 == 0
    (read(spark, sf_dir, "orders").select(
        F.when(broken, F.substring(line, 1, 12)).otherwise(line).alias("value"),
        F.year("o_orderdate").alias("year"))
     .write.partitionBy("year").option("compression", "gzip").text(root))
    schema = "id bigint, body string, seq bigint"
    incoming = raw.read_documents(spark, f"{root}/year=*", schema)
    target = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("body"),
        F.lit(-1).cast("bigint").alias("seq"))
    return joins.upsert_documents(target, incoming, "id", ["seq"], "_corrupt_record")
