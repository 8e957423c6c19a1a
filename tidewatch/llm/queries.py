"""Registered queries over the test tables: operator N is ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, codes, decontaminate, merkle, minhash, oracles, pii, quality, secret_labels, secrets,
               simhash, suffixes, toxicity, urls)
from ..session import cut_lineage
from .common import table

#: Folder of the public vocabulary files on every machine.
TOKENIZERS = "/opt/tokenizers"


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that a labeller found good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no paths; the source of a document stands for its path."""
    docs = table(spark, sf_dir, "documents").withColumn("path", F.col("source"))
    pieces = cut_lineage(secrets.dictionary(docs), "dictionary")
    # read several times by the training
    labels = cut_lineage(secret_labels.labelled(spark, pieces).where("NOT held_out"), "labels")
    model = secrets.train(labels)
    return secrets.scan(secrets.features(secrets.findings(docs), pieces), model)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train(pii.sample_labels(spark))
    return pii.digests(table(spark, sf_dir, "documents"), field)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), trusted(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


def captures(pages: DataFrame) -> DataFrame:
    """Pages, fetched on a day that their number tells."""
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod("page_id", F.lit(1000)).cast("int"))
    return pages.select(F.col("page_id").alias("capture_id"), "url", day.alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A log of two block lists over the hosts of ``pages``, dated by a hash of the host."""
    hosts = pages.select(urls.host_of(F.col("url")).alias("host")).dropna().distinct()
    v = F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int")
    parent = F.when(F.size(F.split("host", r"\.")) > 2, F.regexp_replace("host", r"^[^.]+\.", ""))

    def entry(name: str, domain: Column, action: str, day: Column, when: Column) -> Column:
        at = F.date_add(F.lit("2023-01-01").cast("date"), day)
        return F.when(when, F.struct(F.lit(name).alias("list"), domain.alias("domain"),
                                     F.lit(action).alias("action"), at.alias("at")))

    host = F.col("host")
    log = F.array(
        entry("malware", host, "add", v % 600, v % 3 == 0),
        entry("malware", host, "remove", v % 600 + 30 + v % 97, v % 6 == 0),
        entry("malware", host, "add", v % 600 + 300, v % 12 == 0),
        entry("adult", F.coalesce(parent, host), "add", v % 800, v % 50 == 0),
        entry("adult", F.coalesce(parent, host), "remove", v % 800 + 20, v % 50 == 0))
    return hosts.select(F.explode(log).alias("e")).where("e IS NOT NULL").select("e.*")


URLS_SQL = r"""
WITH seen AS (
  SELECT page_id, DATE '2023-01-01' + CAST(page_id % 1000 AS INTEGER) AS fetched,
         nullif(regexp_replace(lower(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 6) AS INTEGER) AS v,
                 CASE WHEN len(string_split(host, '.')) > 2
                      THEN regexp_replace(host, '^[^.]+\.', '') ELSE host END AS parent
          FROM seen WHERE host IS NOT NULL),
log AS (
  SELECT 'malware' AS list, host AS domain, 'add' AS action, v % 600 AS d FROM hosts WHERE v % 3 = 0
  UNION SELECT 'malware', host, 'remove', v % 600 + 30 + v % 97 FROM hosts WHERE v % 6 = 0
  UNION SELECT 'malware', host, 'add', v % 600 + 300 FROM hosts WHERE v % 12 = 0
  UNION SELECT 'adult', parent, 'add', v % 800 FROM hosts WHERE v % 50 = 0
  UNION SELECT 'adult', parent, 'remove', v % 800 + 20 FROM hosts WHERE v % 50 = 0),
valid AS (
  SELECT list, domain, action, DATE '2023-01-01' + CAST(d AS INTEGER) AS since,
         lead(DATE '2023-01-01' + CAST(d AS INTEGER)) OVER
           (PARTITION BY list, domain ORDER BY d, action DESC) AS until FROM log),
asked AS (
  SELECT page_id, host, fetched, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
    lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS domain FROM seen),
hit AS (
  SELECT DISTINCT page_id, list FROM asked JOIN valid USING (domain)
  WHERE action = 'add' AND fetched >= since AND (until IS NULL OR fetched < until))
SELECT seen.page_id AS capture_id, seen.host,
       coalesce(string_agg(hit.list, ',' ORDER BY hit.list), '') AS lists,
       count(hit.list) > 0 AS blocked
FROM seen LEFT JOIN hit USING (page_id) GROUP BY seen.page_id, seen.host
"""


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(captures(pages), list_entries(pages))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = toxicity.train(docs, labels.select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                                              "score", "predicted")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    messages = (table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
                .union(more))
    return chat.digests(chat.format_conversations(chat.text_parts(messages)))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digests(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffixes": op1_suffixes,
    "op2_secrets": op2_secrets,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_urls": op6_urls,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_chat": op9_chat,
    "op10_bpe": op10_bpe,
    "op11_minhash": op11_minhash,
    "op12_merkle": op12_merkle,
    "op13_codes": op13_codes,
}

ORACLES: dict[str, str] = {"op6_urls": URLS_SQL, "op12_merkle": oracles.merkle_sql(),
                           "op13_codes": oracles.codes_sql()}
