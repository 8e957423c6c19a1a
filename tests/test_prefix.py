"""Prefix sums over ranges, and what is built on them: quartiles, ordered chunks, full batches."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import mapping, thresholds
from tidewatch.operators.prefix import running_sums
from tidewatch.session import cut_lineage


def test_running_sums(spark, frame):
    pick = random.Random(1)
    rows = [("hot" if i % 3 else pick.choice([None, "a", "b"]), i * 7 % 1000, pick.choice([None, 1, 2, 50]))
            for i in range(1000)]
    df = frame(rows, "g string, o int, v int").repartition(7)
    got = running_sums(df, ["g"], ["o"], {"upto": F.col("v"), "place": F.lit(1)}, {"whole": "upto"}).collect()
    by = defaultdict(list)
    for g, o, v in rows:
        by[g].append((o, v or 0))
    assert len(got) == len(rows)
    for r in got:
        before = [v for o, v in by[r.g] if o <= r.o]
        assert (r.upto, r.place, r.whole) == (sum(before), len(before), sum(v for _, v in by[r.g]))
    assert running_sums(df.limit(0), ["g"], ["o"], {"upto": F.col("v")}).count() == 0


def test_no_window_sees_a_whole_group(spark, frame, tmp_path):
    """The windows over rows are by range; those over whole groups see one row per range."""
    frame([("g", i, 1) for i in range(5_000)], "g string, o int, v int").write.parquet(str(tmp_path / "t"))
    ranges = []

    def cut(df):
        ranges.append(cut_lineage(df, "ranges"))
        return ranges[0]

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_sums(spark.read.parquet(str(tmp_path / "t")), ["g"], ["o"], {"upto": F.col("v")}, cut=cut)
        assert got.agg(F.max("upto")).first()[0] == 5_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in ranges[0].groupBy("_range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert sum("_range" in line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in windows) >= 1


@pytest.mark.parametrize("rows", [
    [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", None)], [("a", 5.0)] * 7, [("a", None)],
    [("a", round(x * 0.001, 3)) for x in range(997)] + [("b", -3.5), ("b", 2.25), ("b", 2.25)]])
def test_quartiles(frame, rows):
    got = {r.level: r for r in thresholds.threshold_stats(frame(rows, "level string, threat_index double")).collect()}
    for level in {r[0] for r in rows}:
        known = sorted(v for g, v in rows if g == level and v is not None)
        r = got[level]
        assert r.total_count == sum(g == level for g, _ in rows)
        if not known:
            assert (r.min_val, r.p25, r.median, r.high_threshold) == (None,) * 4
            continue
        at = lambda p: next(v for i, v in enumerate(known, 1) if i >= p * len(known))
        assert (r.min_val, r.max_val) == (known[0], known[-1])
        for name, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
            assert abs(r[name] - at(p)) <= 0.005 + 1e-9


def pairs(frame, *rows):
    return frame([(*r, None) for r in rows], "vendor string, product string, cve string, build_ts timestamp")


def test_chunks_follow_each_other(frame):
    ids = [f"CVE-{i:04d}" for i in range(250)]
    packed = mapping.pack_id_sets(pairs(frame, *[("v", "p", i) for i in ids], ("v", "q", "x")), per_row=40)
    chunks = {(r.product, r.chunk): r.cves for r in packed.collect()}
    assert [i for c in range(7) for i in chunks["p", c]] == ids
    assert [len(chunks["p", c]) for c in range(7)] == [40] * 6 + [10] and chunks["q", 0] == ["x"]


def test_chunks_bounded_by_bytes(frame):
    pick = random.Random(2)
    docs = [(f"CVE-{i:04d}", "x" * pick.randrange(0, 400)) for i in range(200)] + [("CVE-9000", "y" * 5_000), ("CVE-9001", None)]
    sets = mapping.pack_by_bytes(pairs(frame, *[("v", "p", d) for d, _ in docs], ("v", "p", "no document")),
                                 frame(docs, "cve string, document string"), max_bytes=1_000)
    rows = sorted(sets.collect(), key=lambda r: r.chunk)
    assert [i for r in rows for i in r.cves] == sorted(d for d, _ in docs)
    size = {d: len(d) + len(b or "") for d, b in docs}
    for r in rows:
        total = sum(size[i] for i in r.cves)
        assert total <= 1_000 or "CVE-9000" in r.cves and total <= 500 + size["CVE-9000"]
    paired = mapping.pair_documents(sets, frame(docs, "cve string, document string")).collect()
    together = [p for r in sorted(paired, key=lambda r: r.chunk) for p in r.pairs]
    assert [p[0] for p in together] == sorted(size)


def test_full_batches(frame):
    df = frame([(i * 37 % 1009,) for i in range(1_003)], "id int").repartition(5)
    got = mapping.full_batches(df, 10, ["id"]).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.batch] += 1
    assert sorted(sizes) == list(range(101)) and [sizes[b] for b in range(101)] == [10] * 100 + [3]
    in_order = sorted(got, key=lambda r: r.id)
    assert [r.batch for r in in_order] == [i // 10 for i in range(1_003)]


def test_changed_keys_of_two_feeds_at_once(frame):
    side = lambda *rows: frame(list(rows), "feed string, vendor string, product string, cve string")
    new = side(("n", "v", "same", "1"), ("n", "v", "grown", "1"), ("n", "v", "grown", "2"), ("c", "v", "moved", "1"),
               ("n", "v", "touched", "9"))
    old = side(("n", "v", "same", "1"), ("n", "v", "grown", "1"), ("n", "v", "moved", "1"), ("n", "v", "gone", "4"),
               ("n", "v", "touched", "9"), ("c", "v", "left", "9"))
    changed = frame([("9",), ("9",)], "cve string")
    got = mapping.changed_keys(new, old, changed, ["feed"])
    assert sorted(r.product for r in got.collect()) == ["gone", "grown", "left", "moved", "touched"]


def test_change_feed_reads_each_side_once(spark):
    """At most three scans and three exchanges besides those of the sample tables' own joins."""
    ids = lambda n: spark.range(n).selectExpr(
        "'nvd' AS feed", "concat('v', id % 7) AS vendor", "'p' AS product", "cast(id AS string) AS cve")
    new, old, changed = (cut_lineage(ids(n), "side") for n in (100, 90, 5))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        feed = mapping.change_feed([mapping.changed_keys(new, old, changed, ["feed"])], "T")
        plan = feed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("FileScan parquet") == 3
    assert plan.count("Exchange hashpartitioning") <= 3
