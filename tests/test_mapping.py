import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewatch.operators import feeds, mapping
from tidewatch.schemas import AFFECTED_DOCUMENT, CPE_DOCUMENT

LONG = "vendor string, product string, cve string, build_ts timestamp"


def ts(day):
    return F.lit(f"2025-01-{day:02d} 00:00:00").cast("timestamp")


def pairs(frame, *rows, day=1):
    df = frame(list(rows), "vendor string, product string, cve string")
    return mapping.id_pairs(df, ts(day))


def keys(df):
    return sorted((r.vendor, r.product) for r in df.collect())


def test_cpe_and_affected_pairs(frame):
    nvd = {"id": "C-1", "configurations": [{"nodes": [{"cpeMatch": [
        {"criteria": "cpe:2.3:a:foo:bar:1:*"}, {"criteria": "cpe:2.3:o"}]}]}, {"nodes": None}, {}]}
    cna = {"cveMetadata": {"cveId": "C-2"}, "containers": {"cna": {"affected": [
        {"vendor": "Foo ", "product": "Bar"}, {"vendor": "n/a"}]}}}
    parse = lambda rows, schema: frame([(json.dumps(r),) for r in rows], "t string").select(
        F.from_json("t", schema).alias("d")).select("d.*")
    got = mapping.cpe_pairs(parse([nvd, {"id": "C-9"}], CPE_DOCUMENT)).collect()
    assert sorted(map(tuple, got), key=str) == [("foo", "bar", "C-1"), (None, None, "C-1")]
    empty = {"cveMetadata": {"cveId": "C-3"}, "containers": {}}
    got = mapping.affected_pairs(parse([cna, empty], AFFECTED_DOCUMENT)).collect()
    assert sorted(map(tuple, got)) == [("Foo ", "Bar", "C-2"), ("n/a", None, "C-2")]


def test_spellings_share_a_set(frame):
    got = pairs(frame, ("Foo ", "p", "1"), ("foo", "P", "1"), ("foo", "p", "2"), ("N/A", "p", "3"),
                (" *** n/a *** ", "p", "3"), ("", "p", "3"), ("foo", None, "4"), ("foo", "p", None))
    assert sorted((r.vendor, r.product, r.cve) for r in got.collect()) == [
        ("foo", "p", "1"), ("foo", "p", "2")]


def test_packed_sets_keep_every_id(frame):
    rows = [("big", "p", f"{i:04d}") for i in range(1000)] + [("small", "p", "1")]
    packed = mapping.pack_id_sets(pairs(frame, *rows), per_row=100).collect()
    big = [r for r in packed if r.vendor == "big"]
    assert len(big) == 10 and max(len(r.cves) for r in big) < 200
    assert sorted(c for r in big for c in r.cves) == [f"{i:04d}" for i in range(1000)]
    assert [len(r.cves) for r in packed if r.vendor == "small"] == [1]
    assert all(r.cves == sorted(r.cves) for r in packed)


def test_pair_documents_and_raw_records(frame):
    sets = mapping.pack_id_sets(pairs(frame, *[("v", "p", f"CVE-{i}") for i in range(30)]), per_row=10)
    docs = frame([(f"CVE-{i}", "{}") for i in range(0, 30, 2)], "cve string, document string")
    paired = mapping.pair_documents(sets, docs)
    rows = paired.collect()
    assert sorted(p[0] for r in rows for p in r.pairs) == sorted(f"CVE-{i}" for i in range(0, 30, 2))
    assert all([p[0] for p in r.pairs] == sorted(p[0] for p in r.pairs) for r in rows)
    records = mapping.raw_records(paired.limit(0), paired, "2025-05-03T10:11:12+00:00")
    typed = feeds.available_only(records).withColumns({
        "ingestionTimestamp": F.to_timestamp("ingestionTimestamp"),
        "ingestionDate": F.to_date("ingestionDate")})
    assert feeds.stage(typed).count() == 15


def test_snapshot_diff_both_ways(frame):
    old = pairs(frame, ("a", "p", "1"), ("b", "p", "1"), ("b", "p", "2"), ("gone", "p", "1"))
    new = pairs(frame, ("a", "p", "1"), ("b", "p", "1"), ("b", "p", "3"), ("new", "p", "1"), day=2)
    got = {r.vendor: (r.added, r.removed) for r in mapping.snapshot_diff(new, old).collect()}
    assert got == {"b": (1, 1), "new": (1, 0), "gone": (0, 1)}  # Q13: vanished keys count


def test_change_feed(frame):
    old, new = pairs(frame, ("a", "p", "1"), ("b", "p q", "2")), pairs(frame, ("a", "p", "1"), day=2)
    docs = frame([("1", "2025-02-01", None), ("2", None, "2024-01-01")],
                 "cve string, m string, p string")
    changed = mapping.metadata_changed(docs, F.lit("2025-01-01"), ["m", "p"])
    assert [r.cve for r in changed.collect()] == ["1"]
    touched = mapping.touching(new, changed)
    feed = mapping.change_feed([mapping.snapshot_diff(new, old), touched, touched], "T").collect()
    got = {r.label: json.loads(r.body) for r in feed}
    # Q12: touched keys come with their names
    assert got == {"a_p": {"vendor": "a", "product": "p", "ingestionTimestamp": "T"},
                   "b_p_q": {"vendor": "b", "product": "p q", "ingestionTimestamp": "T"}}


def meta(frame, *days):
    rows = frame([("n", d, 1) for d in days], "collection string, d int, count bigint")
    return rows.select("collection", F.make_timestamp(
        F.lit(2025), F.lit(1), "d", F.lit(0), F.lit(0), F.lit(0)).alias("ts"), "count")


@pytest.mark.parametrize("hours, day", [(72, 5), (0, 10), (24 * 30, 2), (1.5, 9)])
def test_baseline(frame, hours, day):
    builds = meta(frame, 2, 5, 9, 10)
    assert mapping.baseline_build(builds, "n", ts(10), hours).first().ts.day == day


def test_baseline_needs_two_builds(frame):
    with pytest.raises(PySparkException, match="at least 2 builds"):
        mapping.baseline_build(meta(frame, 2), "n", ts(9), 1).collect()


def test_build_meta_is_inserted_once(frame):
    both = pairs(frame, ("a", "p", "1"), ("a", "p", "2")).unionByName(
        pairs(frame, ("a", "p", "1"), ("b", "p", "1"), day=2))
    rows = mapping.build_meta(both, "n")
    assert sorted((r.ts.day, r["count"]) for r in rows.collect()) == [(1, 1), (2, 2)]
    known = rows.filter(F.col("ts") == ts(1))
    assert [r.ts.day for r in mapping.build_meta(both, "n", known).collect()] == [2]
    assert mapping.snapshot(both, mapping.newest_build(rows, "n")).count() == 2


def test_browse(frame):
    one = frame([("b", "x"), ("a", "y"), (None, "z")], "vendor string, product string")
    two = frame([("a", "w"), ("a", None), ("c", "y")], "vendor string, product string")
    assert [r.vendor for r in mapping.browse_vendors(one, two).collect()] == ["a", "b", "c"]
    assert [r.product for r in mapping.browse_products("a", one, two).collect()] == ["w", "y"]


def test_batches(frame):
    df = frame([(i,) for i in range(95)], "id int")
    got = mapping.batches_of(df, 10, F.pmod("id", F.lit(3)), ["id"]).groupBy("bucket", "batch").count()
    sizes = [r["count"] for r in got.collect()]
    assert max(sizes) == 10 and sum(sizes) == 95


def test_hierarchy(frame):
    names = frame([("cpe:2.3:a:foo:bar:1:2",), ("cpe:2.3:a:foo:bar",), ("cpe:2.3",)], "cpeName string")
    assert sorted(map(tuple, mapping.cpe_hierarchy(names).collect())) == [
        ("a", "foo"), ("p:bar", "1:2"), ("prefix:cpe", "a"), ("v:foo", "bar")]


def test_a_hot_key_is_spread(frame):
    """The diff shuffles by key and id, so one key's ids do not meet in one task."""
    rows = pairs(frame, ("hot", "p", "1"))
    plan = mapping.snapshot_diff(rows, rows)._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-2:]
    assert all("cve" in line for line in first)


def test_tasks_grow_with_the_rows(frame, monkeypatch):
    """what a task holds does not grow, and sides dealt out alike meet without another shuffle."""
    rows = [(f"v{i % 3}", "p", str(i)) for i in range(95)]
    monkeypatch.setattr(mapping, "ROWS_PER_TASK", 10)
    raw = lambda some: frame(some, "vendor string, product string, cve string")
    assert pairs(frame, *rows).rdd.getNumPartitions() == 10
    new, old = (mapping.id_pairs(raw(side), ts(1), tasks=10) for side in (rows[5:], rows[:90] + rows[:9]))
    diff = mapping.snapshot_diff(new, old)
    plan = diff._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 3 and all("cve" in line and " 10)" in line for line in shuffles[1:])
    assert sorted((r.vendor, r.added, r.removed) for r in diff.collect()) == [
        ("v0", 2, 2), ("v1", 2, 2), ("v2", 1, 1)]
