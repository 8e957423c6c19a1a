"""Streaming queries, run to completion and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mapping
from ..session import workspace
from ..streaming import files
from . import query
from .tables import read


@query("stream_new_files", "SELECT event_id, user_id, event_type, value FROM events")
def stream_new_files(spark, sf_dir):
    schema = read(spark, sf_dir, "events").schema
    out, checkpoint = workspace(spark, "copied"), workspace(spark, "checkpoint")
    for first_run in (True, False):  # the second run finds nothing new
        files.new_files_since(spark, sf_dir, schema, out, checkpoint, first_run,
                              glob="events.parquet").awaitTermination()
    return spark.read.schema(schema).parquet(out).select(
        "event_id", "user_id", "event_type", "value")


@query("stream_dedupe", "SELECT DISTINCT user_id || '-' || event_type AS message_id FROM events")
def stream_dedupe(spark, sf_dir):
    schema = read(spark, sf_dir, "events").schema
    out, checkpoint = workspace(spark, "drained"), workspace(spark, "checkpoint")
    messages = files.read_new_files(spark, sf_dir, schema, glob="events.parquet").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("message_id"),
        F.col("ts").cast("timestamp").alias("ts"))
    files.drain_messages(messages, out, checkpoint, time="ts").awaitTermination()
    return spark.read.schema("message_id string").parquet(out)


_FEED_RUNS = ["2025-05-03T10:11:12+00:00", "2025-05-10T10:11:12+00:00"]
_LONG = "repeat(lower(p_brand), 12) || '-' || p_partkey"


@query("feed_drained", "WITH keys AS (SELECT DISTINCT v, p FROM (SELECT "
       f"{_LONG} AS v, unnest(['a-b', 'a_b', 'a.b']) AS p FROM part)) "
       + " UNION ALL ".join(
           "SELECT '{\"vendor\":\"' || v || '\",\"product\":\"' || p || "
           f"'\",\"ingestionTimestamp\":\"{run}\"}}' AS body FROM keys" for run in _FEED_RUNS))
def feed_drained(spark, sf_dir):
    """Two runs of a feed over long names and names that differ in punctuation, sent twice."""
    keys = read(spark, sf_dir, "part").select(
        F.expr(_LONG).alias("vendor"),
        F.explode(F.array(F.lit("a-b"), F.lit("a_b"), F.lit("a.b"))).alias("product"))
    sent, out, checkpoint = (workspace(spark, n) for n in ("sent", "drained", "checkpoint"))
    for run in _FEED_RUNS:
        feed = mapping.change_feed([keys], run).withColumn("at", F.to_timestamp(F.lit(run)))
        for _ in range(2):
            feed.write.mode("append").parquet(sent)
        stream = files.read_new_files(spark, sent, feed.schema)
        files.drain_messages(stream, out, checkpoint, time="at").awaitTermination()
    return spark.read.schema("body string").parquet(out)


_HALF = "TIMESTAMP '2024-01-15 00:00:00'"


@query("feed_late", f"""
WITH e AS (SELECT user_id || '-' || event_type AS message_id, ts AS sent_at FROM events),
b1 AS (SELECT message_id, min(sent_at) AS sent_at FROM e WHERE sent_at < {_HALF} GROUP BY ALL),
h2 AS (SELECT max(sent_at) - INTERVAL 3 DAY AS h FROM e WHERE sent_at < {_HALF}),
b2 AS (SELECT message_id, min(sent_at) AS sent_at FROM e WHERE sent_at >= {_HALF} AND message_id NOT IN (
  SELECT message_id FROM b1, h2 WHERE CAST(sent_at AS DATE) >= CAST(h AS DATE)) GROUP BY ALL),
h3 AS (SELECT max(sent_at) - INTERVAL 3 DAY AS h FROM e),
b3 AS (SELECT message_id, min(sent_at) AS sent_at FROM e, h3 WHERE sent_at >= h AND message_id NOT IN (
  SELECT message_id FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2) b, h3 WHERE CAST(sent_at AS DATE) >= CAST(h AS DATE)) GROUP BY ALL)
SELECT 'accepted' AS kind, message_id, sent_at FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM b3)
UNION ALL SELECT 'late', message_id, sent_at FROM e, h3 WHERE sent_at < h""")
def feed_late(spark, sf_dir):
    """The first half of all messages, the second half, then all of them once more."""
    sent, out, late, ids, checkpoint = (workspace(spark, n) for n in (
        "sent", "accepted", "late", "ids", "checkpoint"))
    messages = read(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("message_id"),
        F.col("ts").alias("sent_at"))
    half = F.col("sent_at") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part in (half, ~half, F.lit(True)):
        messages.filter(part).write.mode("append").parquet(sent)
        stream = files.read_new_files(spark, sent, messages.schema)
        files.drain_keeping_late(stream, out, late, ids, checkpoint, time="sent_at", delay="3 days").awaitTermination()
    found = lambda kind, path: spark.read.schema(messages.schema).parquet(path).select(
        F.lit(kind).alias("kind"), "message_id", "sent_at")
    return found("accepted", out).unionByName(found("late", late))
