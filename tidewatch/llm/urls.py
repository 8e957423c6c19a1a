"""URL filters over dated block lists: validity intervals and an as-of join.

A list is a log of dated entries: a domain is added to it or removed from it. Entries become
intervals in which a domain is on the list. A capture of a page is judged by the lists as they
stood when it was fetched, for its host and each domain above it.

Captures and intervals meet by domain *and* period: an interval is filed under each period of
``PERIOD_DAYS`` that it touches and in which its domain was captured, so a capture is compared with
the few intervals of its own period and a busy domain is spread over its periods. Within a key rows
differ by range only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD_DAYS = 32


def host_of(url: Column) -> Column:
    """Host of an absolute URL in lower case, without user, port and a last dot; else null."""
    host = F.lower(F.regexp_extract(
        url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(
        F.slice(labels, i + 1, F.size(labels) - i), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, from, until) of a log (list, domain, action, at); until is null if open.

    Entries at the same time count in the order remove, add. An entry of any other action, or with
    a null, says nothing.
    """
    log = (entries.select("list", F.lower("domain").alias("domain"), "action",
                          F.col("at").cast("timestamp").alias("at"))
           .dropna().where("action IN ('add', 'remove')").distinct())
    order = Window.partitionBy("list", "domain").orderBy("at", F.desc("action"))
    return (log.withColumn("until", F.lead("at").over(order)).where("action = 'add'")
            .where("until IS NULL OR until > at")
            .select("list", "domain", F.col("at").alias("from"), "until"))


def _period(at: Column) -> Column:
    return F.floor(F.unix_date(F.to_date(at)) / PERIOD_DAYS).cast("long")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(capture_id, host, lists, blocked): one row for each row of ``captures``.

    ``captures`` has capture_id, url and fetched; ``lists`` names the lists that a capture was on,
    in order, joined by commas. Defined cases: a null or relative URL has a null host and is on no
    list, nor is one without a fetch time; dates may be any that Spark knows; repeated rows are judged one by one; empty tables give
    no rows and block nothing; other columns are ignored.
    """
    seen = (captures.select("capture_id", "url", F.col("fetched").cast("timestamp").alias("fetched"))
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("host", host_of(F.col("url"))).drop("url"))
    asked = seen.select("*", F.explode_outer(domains_of(F.col("host"))).alias("domain"),
                        _period(F.col("fetched")).alias("period"))
    # an interval is filed under those periods alone in which its domain was asked for, so an open
    # one does not reach further than the captures, and a lone far date costs one period
    wanted = asked.select("domain", "period").dropna().distinct()
    valid = intervals(entries)
    reaches = ((F.col("period") >= _period(F.col("from")))
               & (F.col("until").isNull() | (F.col("period") <= _period(F.col("until")))))
    filed = valid.join(wanted, "domain").where(reaches)
    active = ((asked.domain == filed.domain) & (asked.period == filed.period)
              & (asked.fetched >= filed["from"])
              & (filed.until.isNull() | (asked.fetched < filed.until)))
    found = asked.join(filed, active, "left").groupBy("row", "capture_id", "host").agg(
        F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"))
    return found.select("capture_id", "host", "lists", (F.col("lists") != "").alias("blocked"))
