"""Every operator and stage on awkward tables: nulls, empty and long texts, repeats, clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import (bpe, chat, decontaminate, pii, quality, secrets, simhash, suffixes,
                           toxicity, urls)
from tidewatch.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"
CLASHING = ("fp component_id cell e ids decoded spans asked start count words h row key bucket weight "
            "target kept item_id label score toxic p probability features path place").split()
LONG = " ".join(f"word{i} of the long text" for i in range(9_000))
ROWS = [(1, None), (2, ""), (3, "x" * 150_000), (4, LONG), (5, "same old text here " * 12),
        (5, "same old text here " * 12), (None, "a text without a number " * 6), (6, " \t\n\x0b\f\r"),
        (7, "9" * 60_000), (8, "@" * 20_000 + "a@b.c"), (9, "\U0001f600 é 中文 " * 40)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.sample_labels(spark))


@pytest.fixture(scope="module")
def trusted(spark):
    return spark.createDataFrame([(4,), (None,)], "doc_id long")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, "word17 of the long text word18 of the"),
                                  (None, "word17 of the long text word18 of the")],
                                 "item_id long, text string")


def test_suffixes(docs, empty):
    got = suffixes.dedup(docs).collect()
    assert len(got) == len(ROWS) and suffixes.dedup(empty).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[1].n_bytes == 0 and by[2].n_spans == 0
    assert (by[3].n_removed, by[3].n_spans) == (150_000 - 1, 1)  # overlaps count
    five = [r for r in got if r.doc_id == 5]
    assert five[0] == five[1] and five[0].n_removed == 19 * 12 - 19


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS) and simhash.near_duplicates(empty).count() == 0
    blank = {r.doc_id: r for r in got if r.doc_id in (1, 2, 6)}
    assert {r.component_id for r in blank.values()} == {1}
    assert {r.fingerprint for r in blank.values()} == {"0" * 16}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and ids.count(None) == 1 and 2 not in ids


def test_quality(docs, empty, trusted):
    got = quality.judge(docs, trusted).collect()
    assert len(got) == len(ROWS) and quality.judge(empty, trusted).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[1].n_words == 0 and by[6].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[4].n_words == 45_000 and by[3].n_words == 1
    assert by[5].n_repeat_words == 48 and by[5].base_failed
    assert quality.judge(docs, trusted.limit(0)).count() == len(ROWS)
    assert quality.keep_good(docs, trusted).columns == docs.columns


def test_decontamination(docs, empty, benchmark):
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == {(4, 4), (4, None)}
    assert decontaminate.leaks(empty, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
    blocks = decontaminate.leaks(docs, benchmark, block_bytes=20)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == got
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 1


def test_pii(docs, empty, field):
    got = {r.doc_id: r for r in pii.digests(docs, field).collect()}
    assert len(got) == len({i for i, _ in ROWS}) and pii.find(empty, field).count() == 0
    assert got[8].n_email == 1 and got[8].spans == "email:20000:20005" and got[1].spans == ""
    masked = pii.mask(docs, field)
    assert masked.columns == docs.columns
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[1].text is None and rows[8].text == "@" * 20_000 + "[EMAIL]"
    assert rows[8].n_chars == 20_007


def test_toxicity(docs, empty, spark):
    labels = spark.createDataFrame([(4, 0), (5, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}


def test_bpe(docs, empty):
    got = bpe.digests(docs, PATH).collect()
    assert len(got) == len(ROWS) and bpe.digests(empty, PATH).count() == 0
    both = bpe.decode(bpe.encode(docs, PATH), PATH, "back").select("doc_id", "text", "ids", "back")
    for r in both.collect():
        assert r.back == (r.text or "") and (r.ids or not r.text)


def test_secrets(docs, empty):
    pathed = docs.drop("path").withColumn("path", F.lit(None).cast("string"))
    pieces = secrets.dictionary(docs)
    found = secrets.features(secrets.findings(pathed.select("doc_id", "text", "path")), pieces)
    assert {r.doc_id for r in secrets.scan(found, None).collect()} == {3, 7}
    assert secrets.train(found.withColumn("label", F.lit(1))) is None
    assert secrets.findings(empty).count() == 0


def test_urls(spark):
    rows = [(1, None, None), (2, "", None), (3, "no url", None), (4, "http://A.b.C./x?y", "2024-01-05"),
            (4, "http://A.b.C./x?y", "2024-01-05"), (5, "https://u:p@b.c:80", "2024-01-01"),
            (6, "https://b.c", None), (None, "https://x.b.c", "2023-12-31")]
    seen = spark.createDataFrame(rows, "capture_id int, url string, fetched string").withColumns(
        {"row": F.lit(1), "list": F.lit("x"), "period": F.lit(2)})
    log = spark.createDataFrame(
        [("l", "B.c", "add", "2024-01-01"), ("l", "b.c", "remove", "2024-01-06"),
         ("l", "b.c", "add", "2024-01-03"), ("m", "a.b.c", "add", "2024-01-05"),
         ("m", "a.b.c", "remove", "2024-01-05"), ("l", None, "add", "2024-01-01"),
         ("l", "c", "unknown", "2020-01-01")], "list string, domain string, action string, at string")
    got = sorted((r.capture_id or 0, r.lists, r.blocked) for r in urls.judge(seen, log).collect())
    assert got == [(0, "", False), (1, "", False), (2, "", False), (3, "", False), (4, "l,m", True),
                   (4, "l,m", True), (5, "l", True), (6, "", False)]
    assert urls.judge(seen.limit(0), log).count() == 0
    assert {r.blocked for r in urls.judge(seen, log.limit(0)).collect()} == {False}


def test_chat(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "a\\</turn>\n### x: #"), (1, None, "user", "late"),
            (2, 0, "assistant", "hi"), (2, 0, "assistant", "hi"), (None, 0, "odd: role\n", "z")]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumns(
        {"parts": F.lit(1), "formatted": F.lit("x"), "mask": F.lit(2)})
    out = {r.conv_id: r for r in chat.format_conversations(chat.text_parts(frame)).collect()}
    assert chat.read_turns(out[1].formatted) == [("", "a\\</turn>\n### x: #"), ("assistant", ""), ("user", "late")]
    assert chat.read_turns(out[2].formatted) == [("assistant", "hi")] * 2 and len(out[2].mask) == 2
    assert chat.read_turns(out[None].formatted) == [("odd: role\n", "z")]
    assert chat.digests(chat.format_conversations(chat.text_parts(frame.limit(0)))).count() == 0


def test_stages(spark, docs, empty, tmp_path, trusted, benchmark):
    trusted.withColumns({"quality": F.lit(1), "toxic": F.lit(0)}).write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, str(tmp_path))
            out.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
            if name != "tokens":
                assert out.columns == frame.columns
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] in ([], [9])
