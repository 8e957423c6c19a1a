"""Scores, features and odd rows against plain Python."""

import math
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidewatch.llm import quality, secret_labels, secrets, simhash, suffixes, urls


# --- quality rules ------------------------------------------------------------------------

def hashed(word):
    h = xxh64_intdigest(word.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def plain_llr(texts, trusted, buckets):
    half = buckets // 2
    grams = []
    for text in texts:
        h = [hashed(w) for w in text.split()]
        grams.append([x & (half - 1) for x in h]
                     + [((a >> 7) ^ b) & (half - 1) | half for a, b in zip(h, h[1:])])
    raw, hit = Counter(g for gs in grams for g in gs), Counter(g for i in trusted for g in grams[i])
    all_raw, all_hit = sum(raw.values()), sum(hit.values())
    weight = {}
    for g, n in raw.items():
        scaled = hit[g] * (all_raw / all_hit)
        x = math.log(quality.FLOOR + (1 - quality.FLOOR) * (scaled + quality.PRIOR) / (n + quality.PRIOR)) * 1e6
        weight[g] = math.floor(abs(x) + 0.5) * (1 if x > 0 else -1)
    return [math.floor(sum(weight[g] for g in gs) / len(gs)) if gs else 0 for gs in grams]


def test_log_likelihood_ratios(spark):
    pick = random.Random(3)
    words = [f"{pick.choice('bdfgklm')}{pick.choice('aeiou')}{i}" for i in range(300)]
    texts = [" ".join(pick.choices(words[:150] if i % 3 else words[100:], k=pick.randrange(1, 120))) for i in range(60)]
    trusted = [i for i in range(60) if i % 3]
    docs = spark.createDataFrame(list(enumerate([*texts, ""])), "doc_id long, text string").repartition(4)
    good = spark.createDataFrame([(i,) for i in [*trusted, *trusted]], "doc_id long")
    for buckets in (256, quality.BUCKETS):
        expected = plain_llr([*texts, ""], trusted, buckets)
        got = {r.doc_id: r for r in quality.judge(docs, good, buckets=buckets).collect()}
        for i, llr in enumerate(expected):
            assert abs(got[i].llr - llr) <= 1, i
            words_of = ([*texts, ""][i]).split()
            assert got[i].kept == (not got[i].base_failed and got[i].llr >= quality.THRESHOLD)
            assert got[i].base_failed or len(words_of) >= 50
    kept = quality.keep_good(docs.withColumns({"__row": F.lit(1), "h": F.lit("x"), "kept": F.lit(False)}), good)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)
    assert kept.columns == ["doc_id", "text", "__row", "h", "kept"]


def test_texts_are_judged_once(spark):
    """Keeping good rows takes no more work on a text than judging it."""
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(3_000)))], "doc_id long, text string")
    good = docs.select("doc_id")
    steps = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction(")
    kept = quality.keep_good(docs, good, buckets=256)
    assert 0 < steps(kept) <= steps(quality.judge(docs, good, buckets=256))
    assert [r.doc_id for r in kept.collect()] == [1]


# --- URL filters --------------------------------------------------------------------------

def test_any_date(spark):
    """Open entries, and captures at both ends of the calendar and before 1970."""
    days = [date(1, 1, 1), date(1969, 12, 31), date(1970, 1, 1), date(2023, 5, 5), date(9999, 12, 31)]
    captures = spark.createDataFrame([(i, f"http://h{i % 7}.com/x", d) for i, d in enumerate(days * 8)] + [(99, "http://h1.com/", None)],
                                     "capture_id long, url string, fetched date")
    log = [(f"l{k % 2}", f"h{k % 7}.com", "add", datetime(1960 + k, 1, 1)) for k in range(60)]
    log += [("l0", "h3.com", "remove", datetime(2022, 1, 1)), ("far", "h4.com", "add", datetime(9999, 12, 31)),
            ("early", "h5.com", "add", datetime(1, 1, 1)), ("early", "h5.com", "remove", datetime(1969, 12, 31))]
    got = {r.capture_id: r for r in urls.judge(
        captures, spark.createDataFrame(log, "list string, domain string, action string, at timestamp")).collect()}
    for i, d in enumerate(days * 8):
        at, host = datetime(d.year, d.month, d.day), f"h{i % 7}.com"
        active = set()
        for name in ("l0", "l1", "far", "early"):
            seen = sorted((t, a) for n, h, a, t in log if n == name and h == host and t <= at)
            if seen and seen[-1][1] == "add":
                active.add(name)
        assert got[i].lists == ",".join(sorted(active)), (i, d)
    assert got[99].lists == "" and not got[99].blocked


# --- repeated strings -----------------------------------------------------------------------

def removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, bytes(r.kept).decode()) for r in suffixes.dedup(docs).collect()), key=str)


def test_shared_and_missing_ids(spark):
    pick = random.Random(7)
    a, u, b = ("".join(pick.choices("abcdefghij", k=300)) for _ in range(3))
    assert removed(spark, [(1, a), (None, a), (None, u), (8, b)]) == sorted(
        [(1, a), (None, ""), (None, u), (8, b)], key=str)
    got = removed(spark, [(1, a), (None, a), (None, u), (7, a), (7, u)])
    assert got == sorted([(1, a), (7, ""), (7, u), (None, ""), (None, "")], key=str)
    # one id and one text are one document, two ids are two
    assert removed(spark, [(5, a), (5, a), (6, a), (5, b)]) == sorted([(5, a), (5, a), (6, ""), (5, b)], key=str)
    assert removed(spark, [(None, u), (None, u)]) == [(None, u), (None, u)]


# --- near-duplicates without ids --------------------------------------------------------------

def test_copies_without_an_id_go(spark):
    rows = [(4, "one text that comes three times"), (None, "one text that comes three times"),
            (None, "one text that comes three times"), (None, "another text"), (None, "another text"), (9, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(4, "one text that comes three times"), (None, "another text"), (9, None)], key=str)


# --- secrets ------------------------------------------------------------------------------------

LINES = [("plain.txt", "request 123e4567-e89b-12d3-a456-426614174000 was served today", "123e4567-e89b-12d3-a456-426614174000", False),
         ("CHANGELOG.md", "commit 9fceb02d0ae598e95dc970b74767f19372d61af8 by the editor", "9fceb02d0ae598e95dc970b74767f19372d61af8", False),
         ("deploy/.env", 'password = "correcthorsebatterystaple"', "correcthorsebatterystaple", True),
         ("config/settings.yaml", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "04dbebab91ab85687d33eeaaf9ac699e1188f962", True),
         ("src7", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" table', "04dbebab91ab85687d33eeaaf9ac699e1188f962", True),
         ("tests/fixtures/keys.json", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "04dbebab91ab85687d33eeaaf9ac699e1188f962", False),
         ("web/index.html", "see /2024/05/summer-garden-flower-guide today", "/2024/05/summer-garden-flower-guide", False),
         ("src/db/connect.ini", "password = Winter2024", "Winter2024", True),
         ("README", "api_key: settings.SERVICE_KEY", "settings.SERVICE_KEY", False),
         ("page", "number 4968077627624904 there", "4968077627624904", False)]


@pytest.fixture(scope="module")
def forest(spark):
    pieces = spark.createDataFrame([], "piece string")
    table = secret_labels.labelled(spark, pieces).persist()
    return table, secrets.train(table.where("NOT held_out")), pieces


def scanned(spark, lines, model, pieces):
    docs = spark.createDataFrame([(i, p, t) for i, (p, t, *_) in enumerate(lines)], "doc_id long, path string, text string")
    known = pieces.union(spark.createDataFrame([(w[:4],) for w in secret_labels.WORDS], "piece string")).distinct()
    return secrets.scan(secrets.features(secrets.findings(docs), known), model).collect()


def test_held_out_findings(forest):
    table, model, _ = forest
    rows = secrets.scan(table.where("held_out"), model).select("doc_id", "place", "candidate", "secret").join(
        table.select("doc_id", "place", "candidate", "label"), ["doc_id", "place", "candidate"]).collect()
    hit = sum(r.secret and r.label for r in rows)
    found, real = sum(r.secret for r in rows), sum(r.label for r in rows)
    assert len(rows) > 1_000 and 0.2 < real / len(rows) < 0.8
    assert hit / found >= 0.9 and hit / real >= 0.9, (hit / found, hit / real)


def test_verdicts(spark, forest):
    _, model, pieces = forest
    got = {(r.doc_id, r.candidate): r.secret for r in scanned(spark, LINES, model, pieces)}
    wrong = [(LINES[i], got.get((i, c))) for i, (_, _, c, secret) in enumerate(LINES) if got.get((i, c)) != secret]
    assert not wrong, wrong


def test_what_the_forest_looks_at(forest):
    """Coverage, path and neighbouring words each change some verdict."""
    table, model, _ = forest
    rows = table.where("held_out")
    before = {(r.doc_id, r.place, r.candidate): r.secret for r in secrets.scan(rows, model).collect()}
    for group in (["coverage"], ["path_config", "path_test", "path_depth"], ["known_before", "known_after", "keyword_before"]):
        turned = rows.withColumns({c: F.when(F.col(c) > 0, 0.0).otherwise(1.0) for c in group})
        after = {(r.doc_id, r.place, r.candidate): r.secret for r in secrets.scan(turned, model).collect()}
        assert sum(after[k] != v for k, v in before.items()) > 5, group


def test_features_on_any_partitioning(spark, forest):
    _, _, pieces = forest
    docs = secret_labels.lines(spark, 600).select("doc_id", "path", "text")
    known = pieces.union(spark.createDataFrame([(w[:4],) for w in secret_labels.WORDS], "piece string")).distinct()
    words = {w[:4] for w in secret_labels.WORDS}
    whole = lambda df: sorted((tuple(r) for r in secrets.features(secrets.findings(df), known).select(
        "doc_id", "place", "candidate", *secrets.FEATURES).collect()), key=str)
    one = whole(docs.coalesce(1))
    assert one == whole(docs.repartition(7)) and len(one) > 300
    share = lambda c, kept: sum(map(kept, c)) / len(c)
    for r in one:
        c, f = r[2], dict(zip(secrets.FEATURES, r[3:]))
        kinds = ["a" if "a" <= x <= "z" else "A" if "A" <= x <= "Z" else "0" if "0" <= x <= "9" else "-" for x in c]
        changes = sum(x != y for x, y in zip(kinds, kinds[1:])) / len(c)
        covered = set()
        for i in range(len(c) - 3):
            if c[i:i + 4].lower() in words:
                covered |= set(range(i, i + 4))
        expected = {"length": len(c), "changes": changes, "digit_share": share(c, lambda x: x in "0123456789"),
                    "upper_share": share(c, lambda x: "A" <= x <= "Z"), "vowel_share": share(c, lambda x: x in "aeiouAEIOU"),
                    "distinct_share": len(set(c)) / len(c), "coverage": len(covered) / len(c)}
        assert all(abs(f[k] - v) < 1e-9 for k, v in expected.items()), (c, f, expected)


def test_labelled_lines_are_written_once(spark):
    """The labels read the lines from files; the templates are a long expression."""
    pieces = spark.createDataFrame([("abcd",)], "piece string")
    plan = secret_labels.labelled(spark, pieces, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (0, 20," not in plan
