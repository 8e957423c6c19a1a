from pyspark.sql import functions as F

from tidewatch.functions import nested, scoring, text
from tidewatch.operators import lookup
from tidewatch.schemas import CNA_DOCUMENT, NVD_DOCUMENT, SCORES

V31 = "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H"
V2 = "AV:N/AC:L/Au:N/C:P/I:P/A:P"


def doc(text_, schema):
    return F.from_json(F.lit(text_), schema)


def test_normalize_id(value):
    assert value(text.normalize_id(F.lit(" cve-2024-0001é "))) == "CVE-2024-0001"
    assert value(text.normalize_id(F.lit(" cve-1"), trim=False)) == " CVE-1"


def test_names(value):
    assert value(text.clean_name(F.lit("_foo\\_bar baz_"))) == "Foo Bar Baz"
    assert value(text.safe_name(F.lit(".-_a b/c"))) == "a_b_c"
    assert value(text.safe_name(F.lit("..."))) == "file"
    assert value(text.safe_path(F.lit("x y/.z//q"))) == "x_y/z/file/q"
    assert len(value(text.message_label(F.lit("v" * 60), F.lit("p p" * 20)))) == 80


def test_clean_key(value):
    for blank in ("N/A", " *** n/a *** ", "", "  ", None):
        assert value(text.clean_key(F.lit(blank).cast("string"))) is None
    assert value(text.clean_key(F.lit("\tFoo "))) == "foo"


def test_compact_ts(value):
    ts = lambda s: F.lit(s).cast("timestamp")
    assert value(text.compact_ts(ts("2024-01-02 03:04:05.120000"))) == "2024-01-02 03:04:05.12 UTC"
    assert value(text.compact_ts(ts("2024-01-02 03:04:10"))) == "2024-01-02 03:04:10 UTC"
    assert value(text.compact_ts(F.lit("2024-01-02 03:04:10.000"))) == "2024-01-02 03:04:10 UTC"
    assert value(text.compact_ts_or_blank(ts(None))) == ""


def test_cpe_part_and_tags(value):
    assert value(text.cpe_part(F.lit("cpe:2.3:a:v:p:1"), 4)) == "p"
    assert value(text.cpe_part(F.lit("cpe:2.3"), 4)) is None
    assert value(text.strip_tags(F.lit("a<b\nc>d<e>"))) == "ad"


def test_pull_timestamp_formats(value):
    full = value(text.pull_timestamp(F.lit("2025-05-03T10:11:12.123456+00:00")))
    plain = value(text.pull_timestamp(F.lit("2025-05-03T10:11:12+00:00")))
    assert full.microsecond == 123456 and plain.second == 12
    assert value(text.pull_timestamp(F.lit("soon"))) is None


def test_severity_and_weight(value):
    bands = [value(scoring.severity(F.lit(s).cast("double")))
             for s in (9.0, 8.9, 7.0, 4.0, 3.9, 0.0, None)]
    assert bands == ["Critical", "High", "High", "Medium", "Low", "Low", None]
    assert value(scoring.severity(F.lit(None).cast("double"), missing="")) == ""
    weights = [value(scoring.weighted_score(F.lit(s).cast("double"),
                                            scoring.severity(F.lit(s).cast("double"))))
               for s in (9.0, 8.0, 5.0, 2.0, None)]
    assert weights == [9.0, 6.0, 2.5, 0.5, 0.0]


def test_rating_is_strict(value):
    rate = lambda t, lv: value(scoring.risk_rating(F.lit(t).cast("double"), lv))
    assert [rate(t, "daily_vendor") for t in (None, 1, 1.1, 4.1, 6.1, 7, 7.1)] == [
        "Unknown", "None", "Low", "Moderate", "High", "High", "Critical"]
    assert rate(7.1, "daily_product") == "Critical"


def test_q1_vector_is_anchored(value):
    part = lambda m, compat: value(scoring.vector_metric(F.lit(V31), m, compat))
    assert [part(m, False) for m in ("C", "I", "S")] == ["H", "H", "C"]
    assert [part(m, True) for m in ("C", "I", "S")] == ["L", "N", "3.1"]


def test_risk_flags(spark):
    def flags(v, ver, **kw):
        row = spark.createDataFrame([(v, ver)], "vectorString string, cvssVersion string")
        found = lookup.risk_flags(row, **kw).first().asDict()
        return {k: x for k, x in found.items() if k.startswith("is_")}
    assert all(flags(V31, "3.1").values())
    assert not flags(V31, "3.1", compat=True)["is_fully_critical"]
    old = flags(V2, "2.0")
    assert old["is_network_based"] and old["is_no_ui"] and old["is_low_priv"]
    assert not old["is_scope_changed"] and not old["is_fully_critical"]
    assert not any(flags("", "").values())
    assert not any(flags(None, None).values())
    # the first of a repeated component counts
    assert not flags("AV:L/AV:N", "3.1")["is_network_based"]


def test_v2_blanks_the_v3_components(value):
    parts = scoring.cvss_vector(F.lit(V2), F.lit("2.0"))
    got = dict(zip(parts, value(*parts.values())))
    assert got["Au"] == "N" and got["PR"] == got["UI"] == got["S"] == ""


def scores(*entries):
    rows = [{"source": s, "baseScore": b} for s, b in entries]
    import json
    return F.from_json(F.lit(json.dumps(rows)), SCORES)


def test_best_entry(value):
    assert value(scoring.best_entry(scores(("a", 5.0), ("b", 7.0), ("c", 7.0))))["source"] == "b"
    assert value(scoring.best_entry(scores(("a", None)))) is None
    blank = value(scoring.best_entry(scores()))
    assert blank["version"] == "" and blank["baseScore"] is None
    assert value(scoring.best_entry(F.lit(None).cast(SCORES)))["source"] == ""


def cna(metrics=None, adp=None, problems=None, impacts=None):
    import json
    body = {"containers": {"cna": {"metrics": metrics, "problemTypes": problems,
                                   "impacts": impacts}, "adp": adp}}
    return doc(json.dumps(body), CNA_DOCUMENT)["containers"]


def m(score):
    return {"cvssV3_1": {"version": "3.1", "baseScore": score}} if score else {}


def test_alt_cvss_takes_adp_only_where_cna_is_open(value):
    def got(own, other):
        c = cna(own, [{"metrics": other}] if other is not None else None)
        return [s["baseScore"] for s in value(nested.alt_cvss(c["cna"]["metrics"], c["adp"]))]
    assert got([m(5)], [m(9)]) == [5]
    assert got([m(5), m(0)], [m(9)]) == [5, 9]
    assert got(None, [m(9), m(9)]) == [9]
    assert got([], None) == []
    assert got([m(0)], [m(0)]) == []


def problem(cwe, lang="en", kind="CWE"):
    return {"descriptions": [{"type": kind, "lang": lang, "cweId": cwe, "description": f"d{cwe}"}]}


def test_q2_cwe_survives_a_missing_container(value):
    c = cna(problems=[problem("CWE-1"), problem("CWE-1"), problem("CWE-2", "es"),
                      problem(None), problem("CWE-3", "en-US")])
    args = (c["cna"]["problemTypes"], c["adp"])
    ids = [e["cweId"] for e in value(nested.cwe_from_problem_types(*args))]
    assert ids == ["CWE-1", "CWE-3"]
    assert value(nested.cwe_from_problem_types(*args, compat=True)) == []
    c = cna(problems=[problem("CWE-1")], adp=[{"problemTypes": [problem("CWE-9", "es")]}])
    args = (c["cna"]["problemTypes"], c["adp"])
    assert len(value(nested.cwe_from_problem_types(*args, compat=True))) == 1


def test_capec(value):
    text_ = [{"lang": "en", "value": "x"}, {"lang": "es", "value": "y"}]
    c = cna(impacts=[{"capecId": "C-1", "descriptions": text_}, {"descriptions": text_},
                     {"capecId": "C-2"}])
    got = value(nested.capec_from_impacts(c["cna"]["impacts"]))
    assert [(e["capecId"], e["capecDescription"]) for e in got] == [("C-1", "x")]


def test_metric_map_takes_every_key(value):
    body = """{"metrics": {"cvssMetricV2": [{"cvssData": {"version": "2.0", "baseScore": 5}}],
        "cvssMetricV31": [{"cvssData": {"version": "3.1", "baseScore": 7}, "impactScore": 1.5}],
        "other": null, "later": [{"cvssData": {"version": "9"}}]}}"""
    got = value(nested.cvss_from_metric_map(doc(body, NVD_DOCUMENT)["metrics"]))
    assert sorted(e["version"] for e in got) == ["2.0", "3.1", "9"]
    assert value(nested.cvss_from_metric_map(doc("{}", NVD_DOCUMENT)["metrics"])) == []


def test_language_filter_and_labels(value):
    body = """{"descriptions": [{"lang": "es", "value": "s"}, {"lang": "en-US", "value": "a"},
        {"lang": "en", "value": "b"}]}"""
    d = doc(body, NVD_DOCUMENT)["descriptions"]
    assert value(nested.first_english(d)) == "a"
    assert value(F.size(nested.english_only(d))) == 2
    assert value(F.size(nested.english_only(d, "en"))) == 1
    labels = F.from_json(F.lit('[{"i":"1","t":" "},{"i":"2","t":"two"},{"i":"3"}]'),
                         "array<struct<i:string,t:string>>")
    assert value(nested.label_list(labels, "t", "i")) == "1, two, 3"
    assert value(nested.label_list(F.lit(None).cast("array<struct<i:string,t:string>>"),
                                   "t", "i")) == ""


def test_cwe_union(value):
    e = F.from_json(F.lit('[{"cweId":"b"},{"cweId":"a","cweDescription":"x"},'
                          '{"cweId":"b","cweDescription":"y"},{"cweId":"a","cweDescription":"w"}]'),
                    "array<struct<cweId:string,cweDescription:string>>")
    assert [tuple(x) for x in value(nested.cwe_union(e))] == [("a", "x"), ("b", "y")]
