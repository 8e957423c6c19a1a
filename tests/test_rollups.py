from datetime import datetime as dt

import pytest

from tidewatch.operators import lookup, rollups, thresholds
from tidewatch.sources import tables

SCHEMA = ("vendor string, product string, cveId string, datePublished timestamp, cvssScore double, "
          "severity string, cvssVersion string, vectorString string")
FULL = "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H"
LOCAL = "CVSS:3.1/AV:L/AC:L/PR:H/UI:R/S:U/C:L/I:L/A:L"


def finding(cve, score, when=dt(2024, 1, 1), vector=LOCAL, vendor="v", product="p"):
    band = ("" if score is None else "Critical" if score >= 9 else "High" if score >= 7
            else "Medium" if score >= 4 else "Low")
    return (vendor, product, cve, when, score, band, "3.1", vector)


@pytest.fixture
def enriched(frame):
    return lambda *rows: lookup.enrich(frame(list(rows), SCHEMA))


def test_measures(enriched):
    df = enriched(finding("a", 9.5, vector=FULL), finding("a", 9.5, vector=FULL, product="q"),
                  finding("b", 8.0), finding("c", 5.0, vector=FULL), finding("d", 1.0), finding("e", None))
    row = rollups.rollup(df, "ytd_global").first()
    assert (row.total_cves, row.critical_count, row.high_count, row.medium_count, row.low_count) == (
        5, 1, 1, 1, 1)
    assert row.threat_index == 9.5 + 6.0 + 2.5 + 0.25 and row.network_threat_index == 12.0
    assert (row.network_cves, row.no_ui_cves, row.low_priv_cves, row.fully_critical_cves) == (2, 2, 2, 2)
    assert row.risk_rating == "Low" and str(row.year_date) == "2024-01-01"


def test_q4_equal_weights_count_once(enriched):
    df = enriched(finding("a", 9.0), finding("b", 9.0))
    assert rollups.rollup(df, "daily_vendor").first().threat_index == 9.0
    assert rollups.rollup(df, "daily_vendor", dedupe="id").first().threat_index == 18.0


def test_q5_days_or_exact_times(enriched):
    df = enriched(finding("a", 9.0, dt(2024, 1, 1, 1)), finding("b", 8.0, dt(2024, 1, 1, 2)))
    assert rollups.rollup(df, "daily_global").count() == 1
    assert rollups.rollup(df, "daily_global", compat=True).count() == 2


def test_q7_daily_schema_is_the_same_at_all_levels(enriched):
    df = enriched(finding("a", 9.0))
    shapes = [sorted(rollups.rollup(df, f"daily_{lv}").columns) for lv in rollups.LEVEL_KEYS]
    assert shapes[0] == shapes[1] == shapes[2]


def test_half_cents_round_up_whatever_the_order(enriched):
    # 0.1 * 0.25 = 0.025, a tie at two decimals
    assert rollups.rollup(enriched(finding("a", 0.1)), "ytd_global").first().threat_index == 0.03


def test_one_pass_equals_single_views(enriched):
    df = enriched(*[finding(f"c{i % 5}", float(i % 11), dt(2023 + i % 2, 1 + i % 3, 1 + i % 4),
                            FULL if i % 2 else LOCAL, vendor=f"v{i % 3}" if i % 7 else None,
                            product=f"p{i % 2}") for i in range(60)])
    tagged = rollups.rollups(df).cache()
    assert {r.level for r in tagged.select("level").distinct().collect()} == set(rollups.ALL_VIEWS)
    for view in rollups.ALL_VIEWS:
        single, split = rollups.rollup(df, view), rollups.split_view(tagged, view)
        assert sorted(single.columns) == sorted(split.columns)
        split = split.select(*single.columns)
        assert single.exceptAll(split).count() == 0 and split.exceptAll(single).count() == 0


def test_one_expand_serves_all_measures(enriched):
    plan = rollups.rollup(enriched(finding("a", 9.0)), "monthly_vendor")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    expand = [line for line in text.splitlines() if "Expand" in line]
    assert len(expand) == 1 and text.count("Aggregate") == 2


def test_invariants(enriched):
    df = enriched(*[finding(f"c{i}", None if i % 6 == 0 else i % 10 + 0.5, dt(2024, 1 + i % 12, 1))
                    for i in range(40)])
    for row in rollups.rollup(df, "monthly_product").collect():
        scored = row.critical_count + row.high_count + row.medium_count + row.low_count
        assert scored <= row.total_cves
    daily = rollups.rollup(df, "daily_global")
    last = rollups.running_total(daily, "global").orderBy("date_published").collect()[-1]
    assert last.cumulative_threat_index == pytest.approx(sum(r.threat_index for r in daily.collect()))


def test_running_total_spans_years_and_levels(enriched):
    df = enriched(finding("a", 9.0, dt(2023, 12, 31)), finding("b", 9.5, dt(2024, 1, 1)),
                  finding("c", 10.0, dt(2024, 1, 2), vendor="w"))
    run = lambda lv: [r.cumulative_threat_index for r in rollups.running_total(
        rollups.rollup(df, f"daily_{lv}"), lv).orderBy("vendor", "date_published").collect()]
    assert run("global") == [9.0, 18.5, 28.5] and run("vendor") == [9.0, 18.5, 10.0]


def test_running_total_in_blocks(enriched):
    df = enriched(*[finding(f"c{i}", i % 10 + 0.1, dt(2024, 1, 1 + i % 5, i % 24), vendor=f"v{i % 2}")
                    for i in range(80)])
    exact = rollups.rollup(df, "daily_vendor", compat=True)
    plain = rollups.running_total(exact, "vendor", order="datePublished")
    blocks = rollups.running_total(exact, "vendor", order="datePublished", block="date_published")
    assert sorted(plain.columns) == sorted(blocks.columns)
    blocks = blocks.select(*plain.columns)
    assert plain.count() > 10 and plain.exceptAll(blocks).count() == 0


def test_thresholds(frame):
    levels = frame([("x", float(v)) for v in (0, 1, 2, 3, 4, 5, 6, 7)] + [("y", 2.5)],
                   "level string, threat_index double")
    x, y = thresholds.threshold_table(levels).collect()
    assert (x.p25, x.median, x.p75, x.total_count) == (1.0, 3.0, 5.0, 8)
    assert (x.cnt_none, x.cnt_low, x.cnt_moderate, x.cnt_high, x.cnt_critical) == (1, 1, 2, 2, 2)
    assert x.range_moderate == "Moderate = 2 … 3" and x.range_critical == "Critical = > 5"
    assert y.low_threshold == 3.0 and y.cnt_low == 1 and y.range_high == "High = 4 … 3"
    stats = thresholds.threshold_stats(levels)
    assert thresholds.bucket_counts(levels, stats).filter("level = 'x'").first().cnt_high == 2


def test_union_levels(enriched):
    df = enriched(finding("a", 9.0), finding("b", 8.0, vendor="w"))
    views = {v: rollups.rollup(df, v) for v in ("ytd_global", "ytd_vendor")}
    got = sorted(map(tuple, thresholds.union_levels(views).collect()))
    assert got == [("ytd_global", 15.0), ("ytd_vendor", 6.0), ("ytd_vendor", 9.0)]


def test_serving_export_of_every_table(enriched, frame):
    df = enriched(finding("a", 9.0))
    assert len(tables.SERVING_SPECS) == 13
    for view in rollups.ALL_VIEWS:
        got = tables.export_serving(rollups.rollup(df, view), view)
        assert got.columns[0] == "__time" and got.first().rows == 1
        assert {t for _, t in got.dtypes} <= {"timestamp", "string", "bigint", "double"}
    running = rollups.running_total(rollups.rollup(df, "daily_product"), "product")
    row = tables.export_serving(running, "daily_product_running").first()
    assert row.cumulative_threat_index == 9.0 and str(row["__time"]) == "2024-01-01 00:00:00"


def test_serving_append(enriched, spark, tmp_path):
    view = rollups.rollup(enriched(finding("a", 9.0)), "ytd_vendor")
    path = str(tmp_path / "serve")
    tables.write_serving(view, "ytd_vendor", path)
    tables.write_serving(view, "ytd_vendor", path, incremental=True)
    assert spark.read.parquet(path).count() == 2


def test_all_views_without_expanding_rows(enriched, monkeypatch):
    """Distinct ids of all views come out of one shuffle by id."""
    monkeypatch.setattr(rollups, "ROWS_PER_TASK", 1)
    df = enriched(finding("a", 9.0), finding("b", 5.0))
    plan = rollups.rollups(df)._jdf.queryExecution()
    assert "Expand" not in plan.optimizedPlan().toString()
    exchanges = [line for line in plan.executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert sum("cveId" in line for line in exchanges) == 1
