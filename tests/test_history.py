from datetime import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators import history, joins
from tidewatch.schemas import KEYS, SCORES, STAGING

SCHEMA = ("vendor string, product string, cveId string, lastModified timestamp, tag string, "
          "validFrom timestamp, validTo timestamp, currentFlag boolean")
OLD, NEW = dt(2024, 1, 1), dt(2024, 2, 1)
JAN, FEB, MAR = dt(2023, 1, 1), dt(2023, 2, 1), dt(2023, 3, 1)


def target(frame, *rows):
    return frame([("v", "p", k, m, t, OLD, None if c else OLD, c) for k, m, t, c in rows], SCHEMA)


def source(frame, *rows):
    return frame([("v", "p", k, m, t, NEW, None, True) for k, m, t in rows], SCHEMA)


def state(df):
    return sorted((r.cveId, r.tag, r.currentFlag, r.validTo) for r in df.collect())


def test_scd2_conditions(frame):
    t = target(frame, ("null-source", FEB, "t", True), ("older", FEB, "t", True),
               ("equal", FEB, "t", True), ("newer", FEB, "t", True), ("null-target", None, "t", True),
               ("closed", FEB, "t", False), ("untouched", FEB, "t", True))
    s = source(frame, ("null-source", None, "s"), ("older", JAN, "s"), ("equal", FEB, "s"),
               ("newer", MAR, "s"), ("null-target", JAN, "s"), ("closed", JAN, "s"), ("fresh", None, "s"))
    got = state(history.scd2_merge(t, s))
    kept = [(k, "t", True, None) for k in ("null-source", "older", "equal", "untouched")]
    ended = [(k, "t", False, NEW) for k in ("newer", "null-target")]
    added = [(k, "s", True, None) for k in ("newer", "null-target", "closed", "fresh")]
    assert got == sorted([*kept, *ended, *added, ("closed", "t", False, OLD)])
    # the two statements one after the other give the same
    assert state(history.scd2_insert(history.scd2_expire(t, s), s)) == got


def test_same_key_twice_in_a_batch(frame):
    t = target(frame, ("a", JAN, "t", True))
    s = source(frame, ("a", FEB, "s1"), ("a", MAR, "s2"))
    got = history.scd2_merge(t, s)
    assert state(got) == [("a", "s2", True, None), ("a", "t", False, NEW)]
    open_rows = got.filter("currentFlag").groupBy(*KEYS).count()
    assert open_rows.filter("count > 1").count() == 0


def test_merge_is_repeatable(frame):
    t, s = target(frame, ("a", JAN, "t", True)), source(frame, ("a", MAR, "s"))
    once = history.scd2_merge(t, s)
    assert state(history.scd2_merge(once, s)) == state(once)


def test_small_batch_does_not_shuffle_the_history(spark, frame, tmp_path):
    target(frame, ("a", JAN, "t", True)).write.parquet(str(tmp_path / "t"))
    source(frame, ("a", MAR, "s")).write.parquet(str(tmp_path / "s"))
    plan = history.scd2_merge(spark.read.parquet(str(tmp_path / "t")),
                              spark.read.parquet(str(tmp_path / "s")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_q16_hash_variant_keeps_history_hashes(frame):
    add = lambda df: df.withColumn("row_hash", history.row_hash(["tag", "lastModified"]))
    t = add(target(frame, ("same", JAN, "t", True), ("other", JAN, "t", True)))
    s = add(source(frame, ("same", JAN, "t"), ("other", JAN, "changed")))
    got = history.scd2_by_hash(t, s, KEYS, ["lastModified"])
    assert state(got) == [("other", "changed", True, None), ("other", "t", False, NEW),
                          ("same", "t", True, None)]
    before = {r.cveId: r.row_hash for r in t.collect()}
    assert got.filter("cveId = 'other' AND NOT currentFlag").first().row_hash == before["other"]


def test_q17_missing_severity_is_null_in_the_master(spark, frame):
    scores = F.from_json(F.col("vulnStatus"), SCORES)
    rows = frame([("v", "p", "a", '[{"baseScore":7.5,"version":"3.1"}]'), ("v", "p", "b", None)],
                 "vendor string, product string, cveId string, vulnStatus string")
    staging = frame([], STAGING).unionByName(rows.withColumn("cvssData", scores),
                                             allowMissingColumns=True)
    a, b = history.to_master(staging, F.lit(NEW)).orderBy("cveId").collect()
    assert (a.cvssScore, a.cvssVersion, a.severity, a.currentFlag) == (7.5, "3.1", "High", True)
    assert (b.cvssScore, b.cvssVersion, b.severity, b.validTo) == (None, "", None, None)


def test_read_current(frame):
    got = history.read_current(target(frame, ("a", FEB, "t", True), ("b", FEB, "t", False)), "lastModified")
    assert [(r.cveId, r.year_published, r.date_published.month) for r in got.collect()] == [("a", 2023, 2)]


def test_latest_per_key_cuts_before_the_shuffle(spark, frame, tmp_path):
    frame([(1, i) for i in range(50)], "k int, v int").write.parquet(str(tmp_path / "x"))
    df = joins.latest_per_key(spark.read.parquet(str(tmp_path / "x")), ["k"], ["v"])
    assert [tuple(r) for r in df.collect()] == [(1, 49)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_upserts(frame):
    t = frame([("a", 1, "t"), ("b", 1, "t")], "k string, m int, tag string")
    s = frame([("a", 2, "s"), ("b", 1, "s"), ("c", None, "s")], "k string, m int, tag string")
    assert sorted(map(tuple, joins.merge_upsert(t, s, ["k"], ["m"]).collect())) == [
        ("a", 2, "s"), ("b", 1, "t"), ("c", None, "s")]
    docs = frame([("a", 1, "old", None), ("a", 2, "new", None), ("b", 3, "x", "{bad"), (None, 4, "y", None)],
                 "k string, m int, tag string, _corrupt_record string")
    got = joins.upsert_documents(t, docs, "k", ["m"], "_corrupt_record")
    assert sorted(map(tuple, got.collect())) == [("a", 2, "new"), ("b", 1, "t")]


def test_documents_from_yearly_files(spark, frame, tmp_path):
    from tidewatch.sources.raw import read_documents
    (tmp_path / "2024.json").write_text('{"id":"a","m":1}\nbroken\n')
    (tmp_path / "2025.json").write_text('{"id":"a","m":2}\n')
    docs = read_documents(spark, str(tmp_path), "id string, m int")
    got = joins.upsert_documents(frame([("z", 0)], "id string, m int"), docs, "id", ["m"], "_corrupt_record")
    assert sorted(map(tuple, got.collect())) == [("a", 2), ("z", 0)]


def test_merge_helpers(frame):
    left = frame([("a", 1, ["x"]), ("b", None, [])], "k string, n int, s array<string>")
    right = frame([("b", 2, ["y"]), ("c", 3, None)], "k string, n int, s array<string>")
    got = joins.full_merge(left, right, ["k"], {
        "n": F.coalesce("l.n", "r.n"), "s": joins.prefer_filled("r.s", "l.s")})
    assert sorted((r.k, r.n, r.s) for r in got.collect()) == [
        ("a", 1, ["x"]), ("b", 2, ["y"]), ("c", 3, None)]
    first = joins.first_available(left, right, "k")
    assert sorted((r.k, r.n) for r in first.collect()) == [("a", 1), ("b", None), ("c", 3)]
    rows = frame([({"a": 1, "b": 2},), ({"b": 2, "a": 1},), ({"a": 2},)], "m map<string,int>")
    assert joins.distinct_rows(rows).count() == 2
    assert joins.attach(left, right.select("k", F.col("n").alias("r")), ["k"]).count() == 2
    assert [r.k for r in joins.delete_where_exists(left, right, ["k"]).collect()] == ["a"]
