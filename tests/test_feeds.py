import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators import feeds, quality
from tidewatch.schemas import CNA_DOCUMENT, NVD_DOCUMENT, PROFILED, STAGING
from tidewatch.sources import raw, tables

A, B = "2025-05-03T10:00:00.000001+00:00", "2025-05-03T11:00:00+00:00"


def en(text, lang="en"):
    return {"lang": lang, "value": text}


def cna(score=None, adp_score=None, cwe=None, adp_cwe=None, updated="2024-02-01T00:00:00Z",
        text="cna text", capec=None):
    metric = lambda s: [{"cvssV3_1": {"version": "3.1", "vectorString": "CVSS:3.1/AV:N",
                                      "baseScore": s}}] if s else []
    types = lambda c: [{"descriptions": [{"type": "CWE", "lang": "en", "cweId": c,
                                          "description": f"about {c}"}]}] if c else []
    body = {
        "cveMetadata": {"datePublished": "2024-01-01T00:00:00Z", "dateUpdated": updated},
        "containers": {
            "cna": {"descriptions": [en("kein", "de"), en(text)], "metrics": metric(score),
                    "problemTypes": types(cwe),
                    "impacts": [{"capecId": capec, "descriptions": [en("p")]}] if capec else []}}}
    if adp_score or adp_cwe:
        body["containers"]["adp"] = [{"metrics": metric(adp_score), "problemTypes": types(adp_cwe)}]
    return body


def nvd(ident, score=None, status="Analyzed", modified="2024-03-01T00:00:00.000", text="nvd text",
        cwe=None, versions=("cvssMetricV31",), lang="en"):
    entry = {"source": "nvd", "type": "Primary", "impactScore": 1.0, "exploitabilityScore": 2.0,
             "cvssData": {"version": "3.1", "vectorString": "V", "baseScore": score}}
    return {"id": ident, "published": "2024-01-05T00:00:00.000", "lastModified": modified,
            "vulnStatus": status, "descriptions": [en("nada", "es"), en(text, lang)],
            "metrics": {v: [entry] for v in versions} if score is not None else {},
            "weaknesses": [{"description": [en(cwe)]}] if cwe else []}


def record(vendor="v", product="p", at=A, cvelist=(), fkie=(), available=True):
    return {"ingestionDate": at[:10], "ingestionTimestamp": at, "vendor": vendor,
            "product": product, "cveDataAvailable": available,
            "cvelistv5": [list(x) for x in cvelist], "fkie_nvd": [list(x) for x in fkie]}


def read(spark, tmp_path, records, name="raw"):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "a.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    return feeds.available_only(raw.read_raw(spark, str(folder)))


def staged(spark, tmp_path, records, **kw):
    rows = feeds.stage(read(spark, tmp_path, records), **kw).collect()
    return {(r.cveId, r.ingestionTimestamp.hour): r for r in rows}


def test_reading_raw_records(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.json").write_text(json.dumps(record(cvelist=[("C", cna())])) + "\n"
                                           + "not json\n" + json.dumps(record(at=B, available=False)))
    with gzip.open(tmp_path / "x" / "b.json.gz", "wt") as f:
        f.write(json.dumps(record(vendor="zipped", at=B)) + "\n")
    rows = raw.read_raw(spark, str(tmp_path / "x")).collect()
    by = {(r.vendor, r.cveDataAvailable): r for r in rows}
    assert len(rows) == 4
    assert by["v", True].ingestionTimestamp.microsecond == 1
    # element 1 is an object in the file and JSON text in the column
    assert json.loads(by["v", True].cvelistv5[0][1])["cveMetadata"]["dateUpdated"]
    assert by["zipped", True].ingestionTimestamp.hour == 11
    assert by["zipped", True].source_file.endswith("b.json.gz")
    assert by[None, None].cvelistv5 is None


def test_full_outer_merge_and_precedence(spark, tmp_path):
    got = staged(spark, tmp_path, [record(
        cvelist=[(" cve-1é ", cna(score=5.0, cwe="CWE-1", capec="CAPEC-9")), ("cve-2", cna(score=6.0))],
        fkie=[("x", nvd("cve-1 ", 9.0, text="<b>n</b>vd", cwe="CWE-2")), ("y", nvd("CVE-3", 4.0))])])
    assert {k[0] for k in got} == {"CVE-1", "CVE-2", "CVE-3"}
    both, only_cna, only_nvd = (got[f"CVE-{i}", 10] for i in (1, 2, 3))
    assert both.Descriptions == "nvd" and both.vulnStatus == "Analyzed"
    assert [s.baseScore for s in both.cvssData] == [9.0]
    assert list(both.cvssData[0].asDict()) == ["source", "type", "version", "vectorString",
                                               "baseScore", "impactScore", "exploitabilityScore"]
    assert [(c.cweId, c.cweDescription) for c in both.cweData] == [
        ("CWE-1", "about CWE-1"), ("CWE-2", None)]
    assert both.capecData[0].capecId == "CAPEC-9" and both.datePublished.day == 1
    assert only_cna.Descriptions == "cna text" and only_cna.cvssData[0].baseScore == 6.0
    assert only_cna.cweData is None and only_cna.capecData is None and only_cna.lastModified is None
    assert only_nvd.datePublished.day == 5 and only_nvd.dateUpdated is None


def test_cna_scores_fill_in_when_nvd_has_none(spark, tmp_path):
    records = [record(cvelist=[("CVE-1", cna(score=5.0))], fkie=[("x", nvd("CVE-1"))])]
    row = staged(spark, tmp_path, records)["CVE-1", 10]
    assert row.cvssData[0].baseScore == 5.0 and row.vulnStatus == "Analyzed"


def test_q3_unscored_nvd_rows_stay(spark, tmp_path):
    records = [record(fkie=[("x", nvd("CVE-1", cwe="CWE-7"))])]
    row = staged(spark, tmp_path, records)["CVE-1", 10]
    assert row.cvssData is None and row.cweData[0].cweId == "CWE-7"
    compat = feeds.stage(feeds.available_only(raw.read_raw(spark, str(tmp_path / "raw"))), compat=True)
    assert compat.count() == 0


def test_nvd_without_english_text_is_left_out(spark, tmp_path):
    got = staged(spark, tmp_path, [record(
        cvelist=[("CVE-1", cna())], fkie=[("x", nvd("CVE-1", 9.0, lang="fr")),
                                          ("y", nvd("CVE-2", 9.0, lang="fr"))])])
    assert list(got) == [("CVE-1", 10)] and got["CVE-1", 10].vulnStatus is None


def test_feeds_from_different_pulls_meet(spark, tmp_path):
    got = staged(spark, tmp_path, [
        record(at=A, cvelist=[("CVE-1", cna(score=5.0))]),
        record(at=B, fkie=[("x", nvd("CVE-1", 9.0)), ("y", nvd("CVE-2", 3.0))]),
        record(at=A, fkie=[("y", nvd("CVE-2", 2.0))])])
    # the CNA pull takes the NVD data of the other pull; keys only in NVD keep each pull
    assert set(got) == {("CVE-1", 10), ("CVE-2", 10), ("CVE-2", 11)}
    assert got["CVE-1", 10].cvssData[0].baseScore == 9.0
    assert [got["CVE-2", h].cvssData[0].baseScore for h in (10, 11)] == [2.0, 3.0]


def test_q10_repeated_documents_resolve_to_the_newest(spark, tmp_path):
    old, new = cna(score=5.0, text="old"), cna(score=6.0, text="new", updated="2024-05-01T00:00:00Z")
    for name, order in (("one", [old, new, old]), ("two", [new, old, new])):
        rows = feeds.stage(read(spark, tmp_path, [
            record(cvelist=[("CVE-1", d) for d in order])], name)).collect()
        assert len(rows) == 1 and rows[0].Descriptions == "new"
        assert sorted(s.baseScore for s in rows[0].cvssData) == [5.0, 6.0]


def test_broken_documents(spark, tmp_path):
    rec = record()
    rec["cvelistv5"], rec["fkie_nvd"] = [["CVE-1", "{oops"]], [["CVE-2", "{oops"]]
    got = staged(spark, tmp_path, [rec])
    assert list(got) == [("CVE-1", 10)] and got["CVE-1", 10].datePublished is None


def test_q11_ids_of_both_feeds_are_normalised(spark, tmp_path):
    records = [record(cvelist=[("CVE-1", cna())], fkie=[("x", nvd("cve-1", 9.0))])]
    assert len(staged(spark, tmp_path, records)) == 1
    compat = feeds.stage(feeds.available_only(raw.read_raw(spark, str(tmp_path / "raw"))), compat=True)
    assert sorted(r.cveId for r in compat.collect()) == ["CVE-1", "cve-1"]


def test_separate_feeds(spark, tmp_path):
    df = read(spark, tmp_path, [record(cvelist=[("cve-1", cna(score=5.0, adp_score=7.0))],
                                       fkie=[("x", nvd("cve-9", 8.0)), ("z", nvd("cve-8", lang="fr"))])])
    one = feeds.flatten_cna_adp(feeds.parse_pairs(df.drop("fkie_nvd"), "cvelistv5", CNA_DOCUMENT))
    row = one.first()
    assert row.cveId == "CVE-1" and [s.baseScore for s in row.alt_cvssData] == [5.0]
    two = feeds.flatten_nvd(feeds.parse_pairs(df.drop("cvelistv5"), "fkie_nvd", NVD_DOCUMENT))
    assert [r.cveId for r in two.collect()] == ["CVE-9"]
    plan = two._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_documents_are_parsed_once(spark, tmp_path):
    df = feeds.collapse_pulls(feeds.feed_documents(read(spark, tmp_path, [record()])))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2  # one per feed


def test_staging_schema(spark, tmp_path):
    df = feeds.stage(read(spark, tmp_path, [record()]))
    wanted = spark.createDataFrame([], STAGING).schema
    strip = lambda s: s.jsonValue()
    def nullable(t):
        if isinstance(t, dict):
            return {k: nullable(v) for k, v in t.items() if k not in ("nullable", "containsNull", "metadata")}
        return [nullable(x) for x in t] if isinstance(t, list) else t
    assert nullable(strip(df.schema)) == nullable(strip(wanted))
    assert isinstance(df.schema, T.StructType) and df.count() == 0


def test_null_profile(frame):
    df = frame([(None, 1), ("a", None), ("b", None)], "x string, y int")
    row = quality.null_profile(df, "t", F.lit("2025-01-02 03:04:05").cast("timestamp"), ["x", "y"]).first()
    assert (row.totalRecords, row.xNulls, row.yNulls) == (3, 1, 2)
    assert (row.xPercentNull, row.yPercentNull) == (33.33, 66.67)
    empty = frame([], STAGING)
    row = quality.null_profile(empty, "t", F.current_timestamp()).first()
    assert row.totalRecords == 0 and all(row[f"{c}PercentNull"] == 0.0 for c in PROFILED)


def test_stage_counts(frame, tmp_path):
    df, seen = quality.stage_counts(frame([(1,), (2,)], "x int"), "rows")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get["records"] == 2


def test_availability(frame):
    df = frame([([], None), (["a"], []), (None, ["b"])], "cvelistv5 array<string>, fkie_nvd array<string>")
    assert [r.cveDataAvailable for r in feeds.availability_flag(df).collect()] == [False, True, True]


def test_map_keys_and_collapse(frame):
    df = frame([({"a": 1, "b": 2},), ({"b": 3},), (None,)], "m map<string,int>")
    assert sorted(r.key for r in feeds.map_key_list(df, "m").collect()) == ["a", "b"]
    rows = frame([("k", 2, "late", ["x"]), ("k", 1, "early", ["y", "x"])],
                 "k string, o int, s string, a array<string>")
    row = feeds.collapse_chunks(rows, ["k"], ["o"], ["s"], ["a"]).first()
    assert row.s == "early" and sorted(row.a) == ["x", "y"]


def test_compaction_and_tables(spark, tmp_path):
    df = read(spark, tmp_path, [record(vendor=f"v{i}") for i in range(9)]).drop("source_file")
    for compression in (None, "gzip"):
        path = str(tmp_path / f"out-{compression}")
        tables.compact_json(df, path, 3, compression)
        files = [f for f in (tmp_path / f"out-{compression}").iterdir() if f.name.startswith("part")]
        assert len(files) == 3
        assert spark.read.json(path).count() == 9
    tables.compact_json(df, str(tmp_path / "one"), 1, shuffle=False)
    line = next(f for f in (tmp_path / "one").iterdir() if f.name.startswith("part")).read_text()
    assert list(json.loads(line.splitlines()[0]))[:3] == ["ingestionDate", "ingestionTimestamp", "vendor"]


def test_file_names(frame, spark, tmp_path):
    names = ["my_vendor_cve_my_product_raw_2025-03-02_19-55-48.json", "odd.json"]
    good, bad = raw.file_name_metadata(frame([(n,) for n in names], "file_name string")).collect()
    assert (good.vendor, good.product, str(good.ingestionTimestamp)) == (
        "my_vendor", "my_product", "2025-03-02 19:55:48")
    assert not good.incomplete and bad.incomplete and bad.ingestionDate is None
    (tmp_path / names[0]).write_text("{}\n")
    assert raw.with_file_name(spark.read.schema("a int").json(str(tmp_path))).first().file_name == names[0]


def test_latest_partition_and_table(spark, frame, tmp_path):
    df = frame([(1, "2025-01-01"), (2, "2025-01-03"), (3, "2025-01-03")], "id int, ingestionDate string")
    df.write.partitionBy("ingestionDate").parquet(str(tmp_path / "t"))
    got = raw.latest_partition(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r.id for r in got.collect()) == [2, 3]
    for name in ("stage_2025_01_01", "stage_2025_02_01", "stage_other"):
        tables.create_table_as(df, name)
    assert raw.latest_table(spark, "stage") == "stage_2025_02_01"


def test_latest_day_is_staged(spark, tmp_path):
    from tidewatch.plans import staging
    for day, vendor in (("2025-05-02", "old"), ("2025-05-03", "new"), ("notes", "other")):
        (tmp_path / day).mkdir()
        (tmp_path / day / "a.json").write_text(
            json.dumps(record(vendor=vendor, cvelist=[("CVE-1", cna(score=5.0))])) + "\n")
    assert [r.vendor for r in staging.stage_latest(spark, str(tmp_path), "daily").collect()] == ["new"]
    assert raw.latest_table(spark, "daily") == "daily_2025_05_03"
    with pytest.raises(LookupError):
        raw.latest_folder(spark, str(tmp_path / "notes"))


def test_large_shards_are_split(frame, spark, tmp_path, monkeypatch):
    """A shard asked for may not hold any amount of text."""
    monkeypatch.setattr(tables, "SHARD_BYTES", 1_000)
    tables.compact_json(frame([("x" * 100,)] * 90, "a string"), str(tmp_path / "out"), 2, "gzip")
    assert len([f for f in (tmp_path / "out").iterdir() if f.name.startswith("part")]) == 10
    assert spark.read.json(str(tmp_path / "out")).count() == 90
