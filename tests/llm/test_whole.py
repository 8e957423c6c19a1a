"""Cases that the text operators must cover as a whole."""

import random

from pyspark.sql import functions as F

from test_brute import distance
from tidewatch.llm import decontaminate, quality, secrets


def test_quality_of_a_large_corpus(spark):
    pick = random.Random(6)
    words = ["".join(pick.choices("aeioudnrst", k=4)) for _ in range(2_000)]

    def text(bad):
        said = [pick.choice(words[:20]) if pick.random() < 0.5
                else pick.choice(words) + "".join(pick.choices("lmbp", k=5)) for _ in range(300)]
        return " ".join(w.upper() + "!" if bad else w for w in said)

    rows = [(i, text(i % 10 == 0)) for i in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    good = spark.createDataFrame([(i,) for i, _ in rows if i % 10 and i % 3], "doc_id long")
    got = {r.doc_id: r for r in quality.judge(docs, good).collect()}
    assert all(got[i].kept == (i % 10 > 0) for i, _ in rows)


def test_quality_counts_every_trusted_document(spark):
    n = 20_050  # all but one of the documents say "a b"
    docs = spark.range(n).select(F.col("id").alias("doc_id"),
                                 F.when(F.col("id") > 0, "a b").otherwise("c d").alias("text"))
    found = {r.weight for r in quality.weights(docs, docs.select("doc_id")).collect()}
    assert found == {0}  # the trusted documents are the corpus


def test_leaks_of_items_of_every_length():
    pick = random.Random(8)
    for m in list(range(10, 82)) * 3:
        item = "".join(pick.choices("abcdefghijkl", k=m))
        leak, k = list(item), m // 10
        for at in pick.sample(range(m), k):
            leak[at] = pick.choice(["", "x", leak[at] + "y"])
        text = f"some words {''.join(leak)} and more".encode()
        edits = distance(item.encode(), text)
        got = decontaminate.search(decontaminate.build_index([(1, item)]), text)
        assert edits <= k and [(r[0], r[3]) for r in got] == [(1, edits)], (item, text)


def test_leaks_of_words():
    def found(item, text):
        return bool(decontaminate.search(decontaminate.build_index([(1, item)]), text.lower().encode()))

    assert found("Why?", "And why? I ask.") and found("Is it", "is it") and found("x", "(x)")
    assert not found("Why?", "Nowhy?") and not found("is it", "this item") and not found("x", "")
    assert found("is it", "this it, is it") and not found("nine byte", "nine bite")


def test_secrets_of_any_form_behind_a_keyword(spark):
    texts = {1: 'password = "Winter2024"', 2: "db_pwd=P@ssw0rd! and more", 3: "auth: user:pw@host",
             4: '{"api_key": "x1",', 5: "token := ab;", 6: "a plain Winter2024 text: P@ssw0rd!",
             7: "secret=0123456789abcdef0123", 8: 'password = ""', 9: "passwd\n= a\u00e9b"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn(
        "path", F.lit("p"))
    found = secrets.features(secrets.findings(docs), secrets.dictionary(docs))
    got = secrets.scan(found, None).collect()
    assert sorted((r.doc_id, r.candidate) for r in got) == [
        (1, "Winter2024"), (2, "P@ssw0rd!"), (3, "user:pw@host"), (4, "x1"), (5, "ab"),
        (7, "0123456789abcdef0123"), (9, "a\u00e9b")]
    assert found.where("keyword_before = 1 AND assigned = 1 AND coverage BETWEEN 0 AND 1").count() == 7
