"""The history that is partitioned by batch and year, and changed in place."""

import os
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import history
from tidewatch.plans import master
from tidewatch.schemas import KEYS, STAGING
from tidewatch.sources import tables

SCHEMA = ("vendor string, product string, cveId string, datePublished timestamp, lastModified timestamp, "
          "tag string, validFrom timestamp, validTo timestamp, currentFlag boolean")
OLD, NEW, LAST = dt(2024, 1, 1), dt(2024, 2, 1), dt(2024, 3, 1)


def rows(frame, *found, start=OLD):
    """(id, publish year or None, month of lastModified or None, tag) as open rows."""
    return frame([("v", "p", i, y and dt(y, 5, 5), m and dt(2023, m, 1), t, start, None, True)
                  for i, y, m, t in found], SCHEMA)


def state(df):
    return sorted((r.cveId, r.tag, r.currentFlag, r.validTo, r.ended_in, r.year_published)
                  for r in df.collect())


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture
def lake(frame, tmp_path):
    root = str(tmp_path / "history")
    master.start_history(rows(
        frame, ("stays", 2020, 1, "a"), ("changes", 2021, 1, "a"), ("moves", 2021, 1, "a"),
        ("alone", 2022, 1, "a"), ("undated", None, 1, "a"), ("gets a day", None, 1, "a"),
        ("newer here", 2021, 9, "a")).unionByName(
            rows(frame, ("ended before", 2021, 1, "z")).withColumn("currentFlag", F.lit(False))), root)
    return root


def batch(frame):
    return rows(frame, ("changes", 2021, 2, "b"), ("moves", 2023, 2, "b"), ("alone", 2023, 2, "b"),
                ("gets a day", 2024, 2, "b"), ("newer here", 2021, 2, "b"), ("fresh", 2025, None, "b"),
                ("ended before", 2021, 2, "b"), start=NEW)


def expected():
    ended = [("changes", "a", False, NEW, 1, 2021), ("moves", "a", False, NEW, 1, 2021),
             ("alone", "a", False, NEW, 1, 2022), ("gets a day", "a", False, NEW, 1, None),
             ("ended before", "z", False, None, -1, 2021)]
    left = [("stays", "a", 2020), ("undated", "a", None), ("newer here", "a", 2021), ("changes", "b", 2021),
            ("moves", "b", 2023), ("alone", "b", 2023), ("gets a day", "b", 2024), ("fresh", "b", 2025),
            ("ended before", "b", 2021)]
    return sorted(ended + [(i, t, True, None, 0, y) for i, t, y in left], key=str)


def merge(spark, root, df, number):
    master.apply_batch(spark, root, df, number, history.later_modified("lastModified"))


def test_a_batch_touches_its_years_only(spark, frame, lake):
    before = files(lake)
    merge(spark, lake, batch(frame), 1)
    assert sorted(state(master.read_history(spark, lake, SCHEMA)), key=str) == expected()
    after = files(lake)
    untouched = {p: t for p, t in before.items() if "ended_in=-1" in p or "year_published=2020" in p}
    assert len(untouched) == 2 and all(after[p] == t for p, t in untouched.items())
    # the year that lost its only row is gone, and ended rows came as new folders
    assert not any("ended_in=0/year_published=2022" in p for p in after)
    opened = master.read_history(spark, lake, SCHEMA, opened=True)
    assert opened.count() == 9 and opened.filter("NOT currentFlag").count() == 0
    assert master.read_history(spark, lake, SCHEMA, opened=False).filter("currentFlag").count() == 0


def test_a_second_batch_adds_to_ended_rows(spark, frame, lake):
    merge(spark, lake, batch(frame), 1)
    before = files(lake)
    merge(spark, lake, rows(frame, ("changes", 2021, 3, "c"), start=LAST), 2)
    got = [s for s in state(master.read_history(spark, lake, SCHEMA)) if s[0] == "changes"]
    assert got == [("changes", "a", False, NEW, 1, 2021), ("changes", "b", False, LAST, 2, 2021),
                   ("changes", "c", True, None, 0, 2021)]
    after = files(lake)
    assert all(after.get(p) == t for p, t in before.items() if "ended_in=0/year_published=2021" not in p)


@pytest.mark.parametrize("step", ["overwrite_table", "replace_partitions"])
def test_a_run_that_broke_off_can_run_again(spark, frame, lake, monkeypatch, step):
    """Broken before the ended rows are written, or after them, or with some years replaced."""
    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    def some_years(df, path, parts, touched):
        replace(df.filter("year_published = 2021"), path, parts, touched.filter("year_published = 2021"))
        raise RuntimeError("lost")

    replace = tables.replace_partitions
    for fault in [broken] + ([some_years] if step == "replace_partitions" else []):
        with monkeypatch.context() as m:
            m.setattr(tables, step, fault)
            with pytest.raises(RuntimeError):
                merge(spark, lake, batch(frame), 1)
    merge(spark, lake, batch(frame), 1)
    assert sorted(state(master.read_history(spark, lake, SCHEMA)), key=str) == expected()
    merge(spark, lake, batch(frame), 1)
    assert sorted(state(master.read_history(spark, lake, SCHEMA)), key=str) == expected()


def test_open_rows_are_read_once_and_pruned(spark, frame, lake):
    opened = master.read_history(spark, lake, SCHEMA, opened=True).filter("year_published = 2021")
    found = history.merge_changes(opened.drop("ended_in"),
                                  batch(frame).withColumn("year_published", F.year("datePublished")),
                                  history.later_modified("lastModified"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "PartitionFilters: [isnotnull(ended_in" in plan and "year_published" in plan
    assert found.groupBy("_change").count().count() == 3


def test_rows_changed_by_hash(frame):
    add = lambda df: df.withColumn("row_hash", history.row_hash(["tag"]))
    got = history.merge_changes(add(rows(frame, ("same", 2021, 1, "a"), ("other", 2021, 1, "a"))),
                                add(rows(frame, ("same", 2021, 5, "a"), ("other", 2021, 1, "b"))),
                                history.other_hash)
    assert sorted((r._change, r.cveId, r.tag) for r in got.collect()) == [
        ("ended", "other", "a"), ("kept", "same", "a"), ("new", "other", "b")]


def test_merge_from_staging(spark, frame, tmp_path):
    root = str(tmp_path / "m")
    def staged(day, month):
        rows = frame([("v", "p", "x", dt(2022, 1, 1), dt(2023, month, 1))],
                     "vendor string, product string, cveId string, datePublished timestamp, lastModified timestamp")
        return frame([], STAGING).unionByName(rows, allowMissingColumns=True)
    master.merge_partitioned(spark, staged(1, 1), root, 1, F.lit(OLD))
    master.merge_partitioned(spark, staged(2, 1), root, 2, F.lit(NEW))
    got = master.merge_partitioned(spark, staged(3, 2), root, 3, F.lit(LAST))
    assert sorted((r.validFrom, r.validTo, r.ended_in) for r in got.collect()) == [
        (OLD, LAST, 3), (LAST, None, 0)]
    assert KEYS == ["vendor", "product", "cveId"]
