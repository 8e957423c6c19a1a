from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import differences, lookup, refresh, rollups
from tidewatch.plans import master, staging, views
from tidewatch.schemas import KEYS, MASTER, WATERMARK
from tidewatch.session import job_folders, workspace
from tidewatch.sources import tables
from tidewatch.streaming import files

from test_feeds import A, cna, nvd, record

META = "pipeline_name string, last_run_ts timestamp"


def test_watermarks(frame):
    meta = frame([("a", dt(2024, 1, 1)), ("a", dt(2024, 2, 1)), ("b", dt(2025, 1, 1))], META)
    at = lambda m, n: refresh.latest_watermark(m, n).first().last_run_ts
    assert at(meta, "a") == dt(2024, 2, 1) and at(meta, "none") == dt(1970, 1, 1)
    seen = frame([(dt(2024, 5, 1),), (dt(2024, 4, 1),)], "validFrom timestamp")
    moved = refresh.write_watermark(meta, "a", seen, "validFrom")
    # Q8: the greatest time read, and other names keep theirs
    assert at(moved, "a") == dt(2024, 5, 1) and at(moved, "b") == dt(2025, 1, 1)
    assert at(refresh.write_watermark(meta, "a", seen.limit(0), "validFrom"), "a") == dt(2024, 2, 1)


def test_since(frame):
    df = frame([(1, dt(2024, 2, 1), True), (2, dt(2024, 2, 1), False), (3, dt(2024, 1, 1), True),
                (4, None, True)], "id int, validFrom timestamp, currentFlag boolean")
    assert [r.id for r in refresh.since(df, "validFrom", F.lit(dt(2024, 1, 1))).collect()] == [1]


def test_q9_old_and_new_days_are_touched(frame):
    new = frame([("a", dt(2024, 3, 5))], "k string, t timestamp").withColumn("date_published", F.to_date("t"))
    old = frame([("a", dt(2023, 1, 2)), ("z", None)], "k string, t timestamp").withColumn(
        "date_published", F.to_date("t"))
    got = refresh.affected_partitions(new, refresh.replaced_rows(old, new, ["k"]))
    assert sorted((r.year_published, r.month_published) for r in got.collect()) == [(2023, 1), (2024, 3)]


def scored(cve, score, published, valid_from, modified, vendor="foo_bar", product="p", current=True):
    entry = [("s", "t", "3.1", "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H", score, 1.0, 1.0)]
    return (vendor, product, cve, None, None, "ok", entry, published, None, None, None, modified,
            f"text {cve}", valid_from, None, current, score, "3.1", None)


FIRST, SECOND = dt(2025, 1, 1), dt(2025, 1, 8)


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    """A backfill of the first batch refreshed by the second, and a backfill of both."""
    root = tmp_path_factory.mktemp("views")
    before = [scored(f"c{i}", 5.0 + i % 5, dt(2022 + i % 3, 1 + i % 4, 1 + i % 6, i % 24), FIRST, FIRST,
                     vendor=f"v_{i % 3}") for i in range(40)]
    before.append(scored("alone", 9.9, dt(2019, 6, 6), FIRST, FIRST))
    closed = {"c0", "c7", "alone"}
    after = [r[:14] + (SECOND, False) + r[16:] if r[2] in closed else r for r in before]
    after += [scored("c0", 9.9, dt(2022, 1, 1), SECOND, SECOND, vendor="v_0"),       # rescored
              scored("c7", 6.5, dt(2024, 12, 24), SECOND, SECOND, vendor="v_1"),     # moved
              scored("alone", 9.9, dt(2018, 6, 6), SECOND, SECOND),                  # leaves its day empty
              scored("fresh", 8.0, dt(2023, 2, 2), SECOND, SECOND, vendor="v_9")]
    one, two = spark.createDataFrame(before, MASTER), spark.createDataFrame(after, MASTER)
    views.backfill(spark, one, str(root / "inc"))
    views.incremental(spark, two, str(root / "inc"))
    views.backfill(spark, two, str(root / "full"))
    return root


@pytest.mark.parametrize("table", views.TABLES)
def test_incremental_equals_backfill(spark, refreshed, table):
    inc, full = (spark.read.parquet(str(refreshed / side / table)) for side in ("inc", "full"))
    inc = inc.select(*full.columns)
    assert full.count() > 0
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_watermark_after_refresh(spark, refreshed):
    for side in ("inc", "full"):
        rows = spark.read.parquet(str(refreshed / side / "watermark")).collect()
        assert [r.last_run_ts for r in rows] == [SECOND]


def both_sides(spark, root, table):
    inc, full = (spark.read.parquet(f"{root}/{side}/{table}") for side in ("inc", "full"))
    return inc.select(*full.columns), full


def test_undated_shared_names_and_a_crash(spark, tmp_path, monkeypatch):
    """Undated rows, two raw names with one display name, and a run that stops after the lookup."""
    day = dt(2020, 1, 1)
    before = [scored("n1", 3.0, None, FIRST, FIRST), scored("n2", 4.5, None, FIRST, FIRST),
              scored("m1", 5.0, None, FIRST, FIRST), scored("d1", 6.0, day, FIRST, FIRST),
              scored("d2", 7.5, day, FIRST, FIRST),
              scored("same", 5.0, day, FIRST, FIRST, vendor="foo_bar"),
              scored("same", 8.0, day, FIRST, FIRST, vendor="Foo Bar")]
    moved = {"n2", "m1", "d2"}
    after = [r[:14] + (SECOND, False) + r[16:] if r[2] in moved else r for r in before]
    after += [scored("n2", 9.0, None, SECOND, SECOND), scored("m1", 5.5, dt(2021, 2, 2), SECOND, SECOND),
              scored("d2", 7.5, None, SECOND, SECOND)]
    one, two = spark.createDataFrame(before, MASTER), spark.createDataFrame(after, MASTER)
    other = spark.createDataFrame([("other", FIRST)], WATERMARK)
    other.write.parquet(str(tmp_path / "inc" / "watermark"))
    views.backfill(spark, one, str(tmp_path / "inc"))
    with monkeypatch.context() as m:
        m.setattr(views.rollups, "rollups", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            views.incremental(spark, two, str(tmp_path / "inc"))
    views.incremental(spark, two, str(tmp_path / "inc"))
    views.backfill(spark, two, str(tmp_path / "full"))
    for table in views.TABLES:
        inc, full = both_sides(spark, tmp_path, table)
        assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0, table
    assert spark.read.parquet(str(tmp_path / "inc" / "lookup")).filter("cveId = 'same'").count() == 2
    marks = {r.pipeline_name: r.last_run_ts
             for r in spark.read.parquet(str(tmp_path / "inc" / "watermark")).collect()}
    assert marks == {"other": FIRST, "views": SECOND}


def test_late_messages_are_counted(spark, frame, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "message_id string, at timestamp"
    late = []
    for batch in ([("a", dt(2025, 1, 1))], [("b", dt(2025, 3, 1))], [("c", dt(2025, 1, 2))]):
        frame(batch, schema).write.mode("append").parquet(path)
        run = files.drain_messages(files.read_new_files(spark, path, schema), out, check, time="at")
        run.awaitTermination()
        late.append(files.late_rows(run))
    assert late == [0, 0, 1]


def test_touched_partitions_are_pruned(spark, refreshed):
    lookup = spark.read.parquet(str(refreshed / "full" / "lookup"))
    touched = lookup.filter("cveId = 'fresh'").select("year_published", "date_published")
    path = str(refreshed / "touched")
    touched.write.parquet(path)
    hit = refresh.in_partitions(lookup, spark.read.parquet(path), rollups.GRAIN_KEYS["daily"])
    assert "dynamicpruning" in hit._jdf.queryExecution().executedPlan().toString().lower()
    assert hit.filter("cveId = 'fresh'").count() == 1


def test_partial_rollup(spark, refreshed):
    lookup = spark.read.parquet(str(refreshed / "full" / "lookup"))
    touched = refresh.affected_partitions(lookup.filter("cveId = 'fresh'"))
    whole = spark.read.parquet(str(refreshed / "full" / "monthly_vendor"))
    part = refresh.partial_rollup(lookup, touched, "monthly_vendor").select(*whole.columns)
    assert part.count() > 0
    assert part.exceptAll(whole.filter("year_published = 2023 AND month_published = 2")).count() == 0


def test_raw_files_to_views(spark, tmp_path):
    """The whole life of two daily batches."""
    import json
    days = {"d1": [record(cvelist=[("CVE-1", cna(score=5.0))], fkie=[("x", nvd("CVE-2", 9.8))])],
            "d2": [record(at=A.replace("05-03", "05-04"),
                          fkie=[("x", nvd("CVE-2", 4.0, modified="2024-09-01T00:00:00.000"))])]}
    for version, (day, records) in enumerate(days.items(), 1):
        (tmp_path / day).mkdir()
        (tmp_path / day / "a.json").write_text("".join(json.dumps(r) + "\n" for r in records))
        staged = staging.stage_day(spark, str(tmp_path / day), f"staged_{day}")
        history = master.merge_batch(spark, staged, str(tmp_path / "master"), version,
                                     F.lit(dt(2025, 5, 2 + version)))
        (views.backfill if version == 1 else views.incremental)(spark, history, str(tmp_path / "views"))
    assert history.count() == 3 and history.filter("currentFlag").groupBy(*KEYS).count().count() == 2
    lookup = {r.cveId: r for r in spark.read.parquet(str(tmp_path / "views" / "lookup")).collect()}
    assert lookup["CVE-2"].cvssScore == 4.0 and lookup["CVE-2"].severity == "Medium"
    assert lookup["CVE-1"].vendor == "V" and lookup["CVE-1"].lastModified == ""
    ytd = spark.read.parquet(str(tmp_path / "views" / "ytd_global")).first()
    assert ytd.total_cves == 2 and ytd.threat_index == 4.5
    quality = staging.check_quality(spark, "staged_d1", "dq").first()
    assert quality.totalRecords == 2 and quality.vulnStatusNulls == 1


def test_dynamic_overwrite_leaves_other_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(frame([(1, "a"), (2, "b")], "y int, v string"), path, ["y"])
    tables.overwrite_table(frame([(2, "c")], "y int, v string"), path, ["y"], dynamic=True)
    assert sorted((r.y, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]
    touched = frame([(1,), (2,)], "y int")
    tables.replace_partitions(frame([(2, "d")], "y int, v string"), path, ["y"], touched)
    assert sorted((r.y, r.v) for r in spark.read.parquet(path).collect()) == [(2, "d")]


def test_append_table(spark, frame):
    df = frame([("2025-01-01", 1)], "d string, v int")
    tables.append_table(df, "appended", ["d"])
    tables.append_table(df, "appended", ["d"])
    assert spark.table("appended").count() == 2


def test_new_files_only_once(spark, frame, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    run = lambda first=False: files.new_files_since(
        spark, path, "id int", out, check, first).awaitTermination()
    frame([(1,)], "id int").write.parquet(path)
    with pytest.raises(RuntimeError, match="backfill"):
        run()
    run(first=True)
    run()
    frame([(2,)], "id int").write.mode("append").parquet(path)
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


@pytest.mark.parametrize("time", [None, "at"])
def test_messages_are_drained_once(spark, frame, tmp_path, time):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "message_id string, at timestamp, body string"
    for batch in ([("a", dt(2025, 1, 1), "x"), ("a", dt(2025, 1, 1), "y")],
                  [("a", dt(2025, 1, 2), "z"), ("b", dt(2025, 1, 2), "w")]):
        frame(batch, schema).write.mode("append").parquet(path)
        stream = files.read_new_files(spark, path, schema)
        files.drain_messages(stream, out, check, time=time).awaitTermination()
    assert sorted(r.message_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_watermark_schema(spark):
    assert spark.createDataFrame([], WATERMARK).columns == ["pipeline_name", "last_run_ts"]


def test_ids_are_kept_once(frame):
    """an id is stored for the finest view alone; totals by difference are those of the rows left."""
    network, local = ("CVSS:3.1/AV:%s/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H" % c for c in "NL")
    rows = [(f"v{i % 3}" if i % 7 else None, f"p{i % 4}", f"c{i % 11}" if i % 13 else None,
             dt(2022 + i % 2, 1 + i % 3, 1) if i % 5 else None, float(i % 9), "High" if i % 9 > 6 else "Low",
             "3.1", network if i % 2 else local, -1 if i % 4 == 1 else 1) for i in range(80)]
    found = lookup.enrich(frame(
        rows, "vendor string, product string, cveId string, datePublished timestamp, cvssScore double, "
        "severity string, cvssVersion string, vectorString string, sign int"))
    before, going, left = found.filter("sign IS NOT NULL"), found.filter("sign < 0"), found.filter("sign > 0")
    stored, delta = differences.items_of(before), differences.items_of(going, F.col("sign"))
    ids = stored.filter("kind = 'id'")
    assert {r.view for r in ids.select("view").distinct().collect()} == {differences.FINEST}
    assert ids.groupBy("item").agg(F.countDistinct("bucket").alias("n")).filter("n > 1").count() == 0
    same = lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    names = [*differences.KEYS, *differences.TOTALS]
    for got, want in (
            (differences.apply_items(stored, delta), differences.items_of(left)),
            (differences.apply_totals(differences.totals_of(stored), differences.totals_change(stored, delta)),
             differences.totals_of(differences.items_of(left)).select(*names))):
        assert same(got.select(*want.columns), want)
    # and the totals are those of the rows themselves
    totals = differences.totals_of(differences.items_of(left))
    for view in differences.VIEWS:
        want = rollups.rollup(left, view)
        assert same(differences.view_of(totals, view).select(*want.columns), want), view


def test_inner_folders_go_first(spark):
    made = lambda path: spark._jvm.java.io.File(path).exists()
    with job_folders(spark):
        with job_folders(spark):
            path = workspace(spark, "inner")
            spark.range(1).write.parquet(path)
        assert not made(path)
        path = workspace(spark, "outer")
        spark.range(1).write.parquet(path)
        assert made(path)
    assert not made(path)


def test_lookup_is_joined_once(spark, tmp_path, monkeypatch):
    """rows that stay and rows that go come out of one pass over the touched days."""
    rows = [scored(f"c{i}", 5.0 + i % 3, dt(2024, 1 + i % 2, 1), FIRST, FIRST) for i in range(6)]
    after = [r[:14] + (SECOND, False) + r[16:] if r[2] in ("c1", "c3") else r for r in rows]
    after += [scored("c1", 9.0, dt(2024, 1, 1), SECOND, SECOND)] * 2
    one, two = spark.createDataFrame(rows, MASTER), spark.createDataFrame(after, MASTER)
    root, staged = str(tmp_path / "views"), {}
    views.backfill(spark, one, root)
    publish = views._publish

    def look(spark, root, path):
        staged.update({(r.cveId, r.gone): r for r in spark.read.parquet(f"{path}/lookup").collect()})
        publish(spark, root, path)

    monkeypatch.setattr(views, "_publish", look)
    views.incremental(spark, two, root)
    gone = {cve for cve, gone in staged if gone}
    assert gone == {"c1", "c3"} and staged["c1", True].rowKey is None and staged["c1", False].cvssScore == 9.0
    got = sorted((r.cveId, r.cvssScore) for r in spark.read.parquet(f"{root}/lookup").collect())
    assert got == sorted([(r[2], r[16]) for r in rows if r[2] not in gone] + [("c1", 9.0)])


def test_ids_with_one_key_are_not_spread(spark, frame, monkeypatch):
    """an id under one key counts there; ids under several keys, in either state, for each view."""
    rows = lambda *found: lookup.enrich(frame(
        [("v", p, c, dt(2024, m, 1), 8.0, "High", "3.1", "CVSS:3.1/AV:N/UI:N", s) for p, c, m, s in found],
        "vendor string, product string, cveId string, datePublished timestamp, cvssScore double, "
        "severity string, cvssVersion string, vectorString string, sign int"))
    before = rows(("p", "one", 1, 1), ("p", "two", 1, 1), ("q", "two", 1, 1), ("p", "moved", 1, 1),
                  ("p", None, 1, 1), ("q", None, 2, 1), ("q", "other", 2, 1))
    change = rows(("p", "moved", 1, -1), ("q", "moved", 2, 1), ("q", "two", 1, -1), ("p", "one", 2, 1))
    after = rows(("p", "one", 1, 1), ("p", "one", 2, 1), ("p", "two", 1, 1), ("q", "moved", 2, 1),
                 ("p", None, 1, 1), ("q", None, 2, 1), ("q", "other", 2, 1))
    stored, delta = differences.items_of(before), differences.items_of(change, F.col("sign"))
    got = differences.apply_totals(differences.totals_of(stored), differences.totals_change(stored, delta))
    spread, seen = differences._spread, []
    with monkeypatch.context() as m:
        m.setattr(differences, "_spread", lambda df, *a: seen.append(spread(df, *a)) or seen[-1])
        want = differences.totals_of(differences.items_of(after)).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    months = {r.month_published: r.total_cves for r in differences.view_of(got, "monthly_global").collect()}
    assert months == {1: 2, 2: 3} and differences.view_of(got, "ytd_global").first().total_cves == 4
    per_id = [df for df in seen if "_sign" in df.columns]
    assert per_id and per_id[0].filter("item = 'two'").count() == 1 and per_id[0].filter("item = 'one'").count() == 12
