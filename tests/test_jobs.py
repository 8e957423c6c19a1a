"""Jobs that publish: packed files, catalog partitions, late messages, serving tables, stage counts."""

import json
import os
import shutil
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import serving, staging, views
from tidewatch.schemas import MASTER
from tidewatch.sources import tables
from tidewatch.streaming import files

from test_feeds import cna, record
from test_refresh import FIRST, SECOND, scored


def sizes(path):
    return [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")]


def test_shards_have_the_size_asked_for(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i in range(120):
        folder = source / f"d{i % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.json").write_text("".join(json.dumps({"i": i, "k": k}) + "\n" for k in range(20 + i * 3 % 200)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    target = 20_000
    tables.compact_files(spark, str(source), out, target)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    found = sorted(sizes(out))
    total = sum(f.stat().st_size for f in source.rglob("*.json"))
    assert sum(found) == total and found[-1] <= target
    assert all(s >= target / 2 for s in found[1:])  # all but the last one
    lines = spark.read.json(out)
    assert lines.count() == spark.read.option("recursiveFileLookup", "true").json(str(source)).count()
    assert lines.select("i").distinct().count() == 120


def test_readers_see_old_or_new_partitions(spark, frame, tmp_path):
    name, root = "published_test", str(tmp_path / "t")
    rows = lambda *r: frame(list(r), "v string, y int, d string")
    parts = ["y", "d"]
    first = rows(("a", 2020, "x"), ("b", 2021, "x"), ("c", 2021, None), ("d", None, "x"))
    tables.publish_partitions(first, name, parts, root, "1", first.select(*parts))
    read = lambda: sorted(((r.v, r.y, r.d) for r in spark.table(name).collect()), key=str)
    assert read() == sorted(map(tuple, first.collect()), key=str)
    held = {p: os.stat(p).st_mtime_ns for p in map(str, (tmp_path / "t").rglob("*.parquet"))}
    second = rows(("B", 2021, "x"), ("e", 2022, "z"))
    touched = frame([(2021, "x"), (2021, None), (2022, "z"), (1999, "none")], "y int, d string")
    # the rows are written, but nothing points at them yet
    second.write.partitionBy(*parts).parquet(f"{root}/run=2")
    assert len(read()) == 4
    for _ in range(2):
        tables.publish_partitions(second, name, parts, root, "2", touched)
        assert read() == sorted([("a", 2020, "x"), ("B", 2021, "x"), ("d", None, "x"), ("e", 2022, "z")], key=str)
    # nothing of the first run was deleted or written again
    assert all(os.stat(p).st_mtime_ns == t for p, t in held.items())


def test_late_messages_are_kept(spark, frame, tmp_path):
    sent, out, late, ids, check = (str(tmp_path / n) for n in ("in", "out", "late", "ids", "check"))
    schema = "message_id string, at timestamp, body string"
    day = lambda n: dt(2025, 1, 1) + timedelta(days=n)
    batches = [
        [("a", day(0), "1"), ("a", day(1), "2"), ("b", day(9), "3")],
        [("a", day(9), "within the delay of a, but a is older: new again"), ("b", day(10), "repeat"),
         ("c", day(1), "late"), ("late too", day(0), "late"), ("none", None, "no time")],
        [("d", day(30), "far ahead")],
        [("b", day(11), "late now"), ("d", day(30), "repeat")]]
    for batch in batches:
        frame(batch, schema).coalesce(1).write.mode("append").parquet(sent)
        files.drain_keeping_late(files.read_new_files(spark, sent, schema), out, late, ids, check).awaitTermination()
    bodies = lambda path: sorted(r.body for r in spark.read.schema(schema).parquet(path).collect())
    assert bodies(out) == sorted(["1", "3", "within the delay of a, but a is older: new again", "far ahead"])
    assert bodies(late) == sorted(["late", "late", "no time", "late now"])
    # a batch that is run again replaces what it wrote
    os.remove(f"{check}/commits/3")
    for crc in (f"{check}/commits/.3.crc",):
        if os.path.exists(crc):
            os.remove(crc)
    files.drain_keeping_late(files.read_new_files(spark, sent, schema), out, late, ids, check).awaitTermination()
    assert len(bodies(out)) == 4 and len(bodies(late)) == 4


@pytest.fixture
def lake(spark, tmp_path):
    rows = [scored(f"c{i}", 5.0 + i % 5, dt(2022 + i % 2, 1 + i % 3, 1 + i % 2), FIRST, FIRST) for i in range(12)]
    after = [r[:14] + (SECOND, False) + r[16:] if r[2] == "c3" else r for r in rows]
    after.append(scored("c3", 9.9, dt(2022, 5, 5), SECOND, SECOND))
    return spark.createDataFrame(rows, MASTER), spark.createDataFrame(after, MASTER)


def test_serving_job_can_be_repeated(spark, tmp_path, lake):
    root, out, check = (str(tmp_path / n) for n in ("views", "serving", "check"))
    one, two = lake
    views.backfill(spark, one, root)
    with pytest.raises(RuntimeError, match="backfill"):
        serving.publish(spark, root, out, check)
    serving.publish(spark, root, out, check, first_run=True)
    count = lambda: {t: serving.read_serving(spark, out, t).count() for t in tables.SERVING_SPECS}
    first = count()
    assert first["lookup"] == 12 and len(first) == 13 and all(first.values())
    assert "__time" in serving.read_serving(spark, out, "daily_global_running").columns
    views.incremental(spark, two, root)
    some = ["lookup", "ytd_global"]
    serving.publish(spark, root, out, check, names=some)
    second = count()
    assert second["lookup"] > first["lookup"] and second["ytd_global"] > first["ytd_global"]
    # the last batch of a table once more: no row comes twice
    for name in ("1", ".1.crc"):
        path = f"{check}/lookup/commits/{name}"
        if os.path.exists(path):
            os.remove(path)
    serving.publish(spark, root, out, check, names=some)
    assert count() == second


def test_stage_counts_are_stored(spark, tmp_path):
    (tmp_path / "day").mkdir()
    (tmp_path / "day" / "a.json").write_text("".join(json.dumps(r) + "\n" for r in [
        record(cvelist=[("CVE-1", cna(score=5.0)), ("CVE-2", cna(score=6.0))]), record(cvelist=[("CVE-1", cna(score=5.0))])]))
    staging.stage_day(spark, str(tmp_path / "day"), "staged_counted", counts="staged_counts")
    got = {r.stage: r.records for r in spark.table("staged_counts").orderBy("position").collect()}
    assert list(got) == ["read", "available", "collapsed", "staged"]
    assert got["read"] == got["available"] == 2 and got["staged"] == spark.table("staged_counted").count()
