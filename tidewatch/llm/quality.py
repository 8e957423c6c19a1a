"""Quality rules: exact text statistics and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into ``buckets``, half of them for words and half for pairs. Two
multinomials over the buckets are estimated, one from all trusted documents and one from the whole
corpus; the score of a text is the mean over its n-grams of log p(trusted) - log p(corpus). The
trusted one is smoothed towards the corpus: an n-gram seen a few times says little, and one that
trusted documents lack weighs no less than log ``FLOOR``, at any size of the corpus. Texts like the
trusted ones score about zero or more, texts in a style that trusted documents lack score far
below. A text is kept if it fails no base rule and its score reaches a fixed threshold.

Weights are whole millionths, so sums do not depend on the order of rows and each document
gets the same verdict in every run. Texts are judged row by row against one array of all weights,
whose size is fixed by ``buckets``; the corpus is shuffled as counts of buckets alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import SEPARATORS, documents

BUCKETS = 1 << 20
#: N-grams of corpus text that a bucket's counts are smoothed with.
PRIOR = 4
#: Share of the corpus distribution in the trusted one.
FLOOR = 0.1
#: Mean log-likelihood ratio of an n-gram that a kept document reaches, in millionths.
THRESHOLD = -300_000
SYMBOLS = "#*$%&|<>"
#: Ids of trusted documents that are broadcast at most, some 32 MB.
SENT_IDS = 1 << 21


def _worded(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with words and h: a null text is empty; ``h`` has a 64-bit hash of
    each word."""
    inner = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    return (docs.withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("inner", inner)
            .withColumn("words", F.when(F.col("inner") == "", F.array().cast("array<string>"))
                        .otherwise(F.split("inner", SEPARATORS)))
            .withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
            .drop("inner"))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.size(lines) - F.size(F.array_distinct(lines))


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """``df`` with n_repeat_words: words in three-word windows found twice or more, each once.

    A window's hash and its place share one long, the place in as many low bits as the text
    needs, so that a plain sort of longs brings equal windows together. Neighbours whose high bits
    agree are then compared by their whole hashes.
    """
    h, g, s, places = F.col("h"), F.col("__g"), F.col("__s"), F.col("__places")

    def same(x: Column, y: Column) -> Column:
        whole = (F.get(g, x.bitwiseAND(places).cast("int"))
                 == F.get(g, y.bitwiseAND(places).cast("int")))
        return F.coalesce(x.bitwiseXOR(y).between(0, places) & whole, F.lit(False))

    def covered(p: Column) -> Column:
        # a window covers three words, fewer where the next one starts among them
        return F.aggregate(F.transform(p, lambda x, k: F.coalesce(
            F.least(F.lit(3), F.get(p, k + 1) - x), F.lit(3))), F.lit(0).cast("long"),
            lambda a, x: a + x)

    # the two windows that run over the end are hashed from fewer words and equal no other
    tagged = (df.withColumn("__g", F.transform(h, lambda x, i: F.xxhash64(
                  x, F.get(h, i + 1), F.get(h, i + 2))))
              .withColumn("__bits", F.length(F.bin(F.size("h").cast("long"))))
              .withColumn("__places", F.expr("shiftleft(1L, __bits) - 1"))
              # most short texts repeat nothing and need no more than this
              .withColumn("__repeats", F.size(F.array_distinct("__g")) < F.size("__g"))
              .withColumn("__s", F.when(F.col("__repeats"), F.sort_array(F.expr(
                  "transform(__g, (x, i) -> shiftleft(x, __bits) | i)")))))
    found = F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1)))
    starts = F.sort_array(F.transform(found, lambda x: x.bitwiseAND(places)))
    # a lambda over a single element evaluates the sorted starts once per text
    total = F.get(F.transform(F.array(starts), covered), F.lit(0))
    return (tagged.withColumn("n_repeat_words",
                              F.when(F.col("__repeats"), total).otherwise(F.lit(0)))
            .drop("__g", "__bits", "__places", "__repeats", "__s"))


def _ngrams(h: Column, buckets: int) -> Column:
    """Buckets of all words, then of all pairs of neighbours; ``buckets`` is a power of two."""
    half = buckets // 2
    mask = F.lit(half - 1).cast("long")
    seconds = F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0)))
    pairs = F.transform(seconds, lambda x, i: F.shiftright(F.get(h, i), 7).bitwiseXOR(x)
                        .bitwiseAND(mask).bitwiseOR(F.lit(half).cast("long")).cast("int"))
    return F.concat(F.transform(h, lambda x: x.bitwiseAND(mask).cast("int")), pairs)


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with h and the base columns; a null text is empty."""
    text, words = F.col("text"), F.col("words")
    symbols = len(SYMBOLS) * F.length(text)
    for s in SYMBOLS:
        symbols = symbols - F.length(F.replace(text, F.lit(s), F.lit("")))
    counted = _worded(docs).select(
        *docs.columns, "h", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        _dup_lines(text).cast("long").alias("n_dup_lines"))
    return _with_repeat_words(counted)


def weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight): smoothed log-likelihood ratios in millionths, ``buckets`` rows at most.

    Corpus counts cover all of ``docs``, the others all documents whose doc_id ``trusted`` has.
    """
    chosen = (trusted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
              .withColumn("target", F.lit(1)))
    # ids are sent to the texts as long as they are known to be few; beyond that texts are shuffled
    if chosen.limit(SENT_IDS + 1).count() <= SENT_IDS:
        chosen = F.broadcast(chosen)
    marked = documents(docs).join(chosen, "doc_id", "left").select("text", "target")
    grams = _worded(marked).select("target", F.explode(_ngrams(F.col("h"), buckets)).alias("bucket"))
    # written, as the totals read them too: ``buckets`` rows at most
    counts = cut_lineage(grams.groupBy("bucket").agg(F.count("*").alias("raw"),
                                                     F.count("target").alias("hit")), "buckets")
    totals = counts.agg(F.sum("raw").alias("all_raw"), F.sum("hit").alias("all_hit"))
    # trusted n-grams at the rate of the corpus would give ``raw``
    scaled = F.when(F.col("all_hit") > 0, F.col("hit") * (
        F.col("all_raw") / F.nullif(F.col("all_hit"), F.lit(0)))).otherwise(F.col("raw"))
    ratio = F.log(FLOOR + (1 - FLOOR) * (scaled + PRIOR) / (F.col("raw") + PRIOR))
    # one row of totals beside at most ``buckets`` rows
    return (counts.join(F.broadcast(totals))
            .select("bucket", F.round(ratio * 1_000_000).cast("long").alias("weight")))


def weight_array(weighed: DataFrame, buckets: int = BUCKETS) -> Column:
    """All weights in order of their buckets as one value, four bytes each; zero where there is none.

    Four megabytes at ``BUCKETS`` whatever the corpus, so that every task can hold them.
    """
    every = weighed.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    filled = every.join(weighed, "bucket", "left").select(
        F.struct(F.col("bucket").cast("int").alias("bucket"),
                 F.coalesce("weight", F.lit(0)).cast("int").alias("weight")).alias("w"))
    return (filled.agg(F.sort_array(F.collect_list("w")).alias("w"))
            .select(F.col("w.weight").alias("weights")).scalar())


def _judged(docs: DataFrame, table: Column, threshold: int, buckets: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the base columns, llr, base_failed and kept, row by row."""
    # Spark takes no subquery within a lambda, but puts a column that is used once in its place
    total = F.aggregate(_ngrams(F.col("h"), buckets), F.lit(0).cast("long"),
                        lambda a, b: a + F.get(F.col("__table"), b))
    # words, and pairs of neighbours
    grams = 2 * F.col("n_words") - 1
    llr = F.when(F.col("n_words") > 0, F.floor(total / grams)).otherwise(0)
    failed = ((F.col("n_words") < 50)
              | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return (statistics(docs).withColumn("__table", table).withColumn("llr", llr.cast("long"))
            .drop("h", "__table")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)))


def judge(docs: DataFrame, trusted: DataFrame, threshold: int = THRESHOLD,
          buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base columns, llr, base_failed, kept.

    ``llr`` is the mean weight of the n-grams in millionths, zero where there are none.
    Defined cases: a null text has no words and fails the base rules; repeated rows are judged
    one by one; a null doc_id is kept in the result; without trusted documents every
    weight is zero and the base rules alone decide; an empty table gives no rows.
    """
    table = weight_array(weights(docs, trusted, buckets), buckets)
    return _judged(documents(docs), table, threshold, buckets).drop("text")


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: int = THRESHOLD,
              buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns."""
    table = weight_array(weights(docs, trusted, buckets), buckets)
    # the other columns travel in one, whatever their names
    whole = docs.select(F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                        F.col("text").cast("string").alias("text"))
    # a filter would be moved below the statistics, with all of them written out in its condition for
    # each of their uses; rows that an explode leaves out are judged once
    kept = F.explode(F.when(F.col("kept"), F.array("__row"))).alias("__row")
    return _judged(whole, table, threshold, buckets).select(kept).select("__row.*")
