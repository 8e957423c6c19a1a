"""Secret scans: candidate strings, judged by a random forest.

A candidate is a run of ``MIN_LENGTH`` or more characters that keys are made of, or what a keyword
and an assignment sign stand before: any non-blank characters, however few. Most candidates are
harmless: long words, numbers, addresses. The forest tells them from secrets by the
length of the run, the changes between kinds of characters in it, the share of it that
dictionary pieces cover, the path of the text and the words around it. It is trained from
labelled findings. All of it runs in the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import SEPARATORS

MIN_LENGTH = 16
RUN = r"[A-Za-z0-9+/_-]{16,}"
#: Share of all words that a piece of the dictionary begins; there are 50,000 such pieces at most.
SHARE = 2e-5
PIECE = 4
#: Labelled findings that training takes at most, by hash.
MAX_FINDINGS = 20_000
KEYWORDS = r"(?i)(secret|token|passw|passwd|pwd|api|auth|bearer|credential|private|access|key)"
#: A keyword, the rest of its name and an assignment sign, with a blank around the sign or none.
ASSIGNMENT = KEYWORDS + r"[\w.-]*+[\"'\])]*+[\x20\x09-\x0D]*+(?::=|=>|==?|:)"
#: The value at the end of three words joined by spaces; group 2, quotes and commas behind included.
ASSIGNED = ASSIGNMENT + r"\x20?[\"'`]*([^\x20\x09-\x0D=:>\"'`][^\x20\x09-\x0D]*)$"
CLOSING = r"([\"'`][),;\]}]*|[,;]+)$"
FEATURES = ["length", "changes", "digit_share", "upper_share", "vowel_share", "distinct_share",
            "coverage", "path_depth", "path_config", "path_test", "keyword_before", "assigned",
            "quoted", "known_before", "known_after"]


def findings(docs: DataFrame) -> DataFrame:
    """(doc_id, path, place, before, word, after, candidate): ``place`` is the number of the word.

    ``docs`` has doc_id, text and path. ``before`` holds the two words before the candidate's.
    """
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # texts without a run long enough and without an assignment need not be split
    words = words.where(F.col("text").rlike(RUN) | F.col("text").rlike(ASSIGNMENT)).select(
        "doc_id", "path", F.split("text", SEPARATORS).alias("words"))
    w = F.col("words")
    at = F.col("place")

    def near(x: Column, i: Column) -> Column:
        return F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1), x)

    def some_at(x: Column, i: Column) -> Column:
        signed = x.rlike("[=:]") | F.coalesce(F.get(w, i - 1), F.lit("")).rlike("[=:]>?$")
        return F.when(x.rlike(RUN) | (signed & near(x, i).rlike(ASSIGNED)), i)

    some = F.filter(F.transform(w, some_at), lambda i: i.isNotNull())

    def word(offset: int) -> Column:
        return F.coalesce(F.get(w, at + offset), F.lit(""))

    runs = F.regexp_extract_all("word", F.lit(RUN), 0)

    return (words.withColumn("place", F.explode(some))
            .select("doc_id", "path", "place",
                    F.concat_ws(" ", word(-2), word(-1)).alias("before"),
                    word(0).alias("word"), word(1).alias("after"))
            .withColumn("value", F.regexp_replace(F.regexp_extract(
                F.concat_ws(" ", "before", "word"), ASSIGNED, 2), CLOSING, ""))
            # a value that is a run is there once
            .select("*", F.explode(F.concat(runs, F.when(
                (F.col("value") != "") & ~F.array_contains(runs, F.col("value")),
                F.array("value")).otherwise(F.array().cast("array<string>")))).alias("candidate"))
            .drop("value"))


def dictionary(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """(piece): the ``PIECE``-letter beginnings that at least ``share`` of all words have.

    All words of all texts are counted. The share bounds the number of pieces at any size of the corpus.
    """
    words = docs.select(F.explode(F.split(F.col("text").cast("string"), SEPARATORS)).alias("w"))
    pieces = words.select(F.lower(F.substring("w", 1, PIECE)).alias("piece"))
    counts = cut_lineage(pieces.where(F.col("piece").rlike(rf"^\p{{L}}{{{PIECE}}}$"))
                         .groupBy("piece").count(), "pieces")
    return counts.where(F.col("count") >= share * counts.agg(F.sum("count")).scalar()).select("piece")


def _share(text: Column, pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace(text, pattern, "")) / F.length(text)


def features(found: DataFrame, pieces: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``.

    The findings are numbered and written first: they are read twice, once for their places in the
    dictionary, and must keep their numbers.
    """
    found = cut_lineage(found.withColumn("row", F.monotonically_increasing_id()), "findings")
    c = F.col("candidate")
    kinds = c
    for pattern, mark in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "0"), ("[^A-Za-z0]", "-")):
        kinds = F.regexp_replace(kinds, pattern, mark)
    bare = F.lower(F.regexp_replace(F.col("before"), r"^.* ", ""))
    place = F.instr(F.col("word"), c)
    lead = F.substring(F.col("word"), F.lit(1), place - 1)
    base = (found.select(
        "*", F.length(c).cast("double").alias("length"),
        ((F.length(F.regexp_replace(kinds, r"(.)\1*", "$1")) - 1) / F.length(c)).alias("changes"),
        _share(c, "[0-9]").alias("digit_share"), _share(c, "[A-Z]").alias("upper_share"),
        _share(c, "[AEIOUaeiou]").alias("vowel_share"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("distinct_share"),
        F.size(F.split("path", "/")).cast("double").alias("path_depth"),
        F.col("path").rlike(r"(?i)\.(env|ini|cfg|conf|ya?ml|json|pem|properties|toml)$")
        .cast("double").alias("path_config"),
        F.col("path").rlike(r"(?i)(test|example|sample|mock|fixture|doc)").cast("double")
        .alias("path_test"),
        F.concat("before", lead).rlike(KEYWORDS).cast("double").alias("keyword_before"),
        F.concat("before", lead).rlike(r"[=:][\s\"']*$").cast("double").alias("assigned"),
        lead.rlike(r"[\"']$").cast("double").alias("quoted"),
        F.substring(bare, 1, PIECE).alias("piece_before"),
        F.substring(F.lower("after"), 1, PIECE).alias("piece_after")))
    known = pieces.withColumn("known", F.lit(1))
    # places of the candidate that lie in a piece of the dictionary
    spread = base.where(F.length("candidate") >= PIECE).select("row", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.length("candidate") - PIECE + 1),
        lambda i: F.lower(F.substring(F.col("candidate"), i, F.lit(PIECE))))).alias("at", "piece"))
    covered = (spread.join(known, "piece")
               .select("row", F.explode(F.sequence(F.col("at"), F.col("at") + PIECE - 1)).alias("at"))
               .groupBy("row").agg(F.count_distinct("at").alias("covered")))
    for side in ("before", "after"):
        base = (base.join(known.withColumnsRenamed({"piece": f"piece_{side}",
                                                    "known": f"known_{side}"}),
                          f"piece_{side}", "left")
                .withColumn(f"known_{side}", F.coalesce(f"known_{side}", F.lit(0)).cast("double")))
    return (base.join(covered, "row", "left")
            .withColumn("coverage", F.coalesce(F.col("covered") / F.col("length"), F.lit(0.0)))
            .drop("row", "covered", "piece_before", "piece_after"))


def train(labelled: DataFrame, max_findings: int = MAX_FINDINGS, trees: int = 40, depth: int = 6,
          seed: int = 5) -> RandomForestClassificationModel | None:
    """Fits the forest on at most ``max_findings`` rows with ``FEATURES`` and ``label``, half of
    them of either label where there are enough; None without both labels."""
    rows = None
    for label in (0, 1):
        part = (labelled.where(F.col("label") == label).select(*FEATURES, "label")
                .orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(max_findings // 2))
        rows = part if rows is None else rows.union(part)
    # the bounded sample goes into one partition in a fixed order, so that trees do not depend
    # on how the findings were spread
    rows = rows.coalesce(1).sortWithinPartitions("label", *FEATURES)
    if rows.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        rows.withColumn("label", F.col("label").cast("double")))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(
        data.select("features", "label"))


def scan(featured: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """(doc_id, place, candidate, probability, secret) of findings with ``FEATURES``.

    Defined cases: null and empty texts have no findings; repeated rows are judged one by one; a null
    doc_id stays null and a null path is empty; without a model every probability is 0.5 and all
    are reported as secrets; an empty table gives no rows; other columns are ignored.
    """
    if model is None:
        scored = featured.withColumn("p", F.lit(0.5))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
            featured)).withColumn("p", vector_to_array("probability")[1])
    return scored.select("doc_id", F.col("place").cast("long").alias("place"), "candidate",
                         F.round("p", 6).alias("probability"), (F.col("p") >= 0.5).alias("secret"))
