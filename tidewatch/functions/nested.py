"""Array, map and struct expressions on parsed feed documents.

Each works inside one row, so nothing is exploded and regrouped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PATTERNS, SCORE_FIELDS, SCORES, WEAKNESSES


def or_empty(arr: Column) -> Column:
    return F.coalesce(arr, F.array())


def _is_english(x: Column) -> Column:
    return x["lang"].like("en%")


def english_only(arr: Column, pattern: str = "en%") -> Column:
    """Entries in any English; ``pattern="en"`` keeps only those without a region."""
    return F.filter(arr, lambda x: x["lang"].like(pattern))


def first_english(arr: Column) -> Column:
    return F.get(english_only(arr), 0)["value"]


def order_struct_fields(arr: Column, fields: list[str] = SCORE_FIELDS) -> Column:
    """Same entries with their fields in the given order."""
    return F.transform(arr, lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def empty_to_null(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def label_list(arr: Column, text: str, ident: str) -> Column:
    """Descriptions, or ids where the description is blank, joined by commas."""
    return F.array_join(
        F.transform(or_empty(arr),
                    lambda x: F.when(F.trim(x[text]) != "", x[text]).otherwise(x[ident])),
        ", ")


def _plain_score(v31: Column) -> Column:
    absent = {"source": "string", "type": "string",
              "impactScore": "double", "exploitabilityScore": "double"}
    return F.struct(*[
        (F.lit(None).cast(absent[f]) if f in absent else v31[f]).alias(f) for f in SCORE_FIELDS])


def alt_cvss(cna_metrics: Column, adp: Column) -> Column:
    """CNA v3.1 scores; ADP ones join in only where the CNA leaves a score open."""
    scores = lambda metrics: F.transform(or_empty(metrics), lambda m: m["cvssV3_1"])
    present = lambda arr: F.filter(arr, lambda s: s.isNotNull())
    own = scores(cna_metrics)
    left_open = (F.size(own) == 0) | F.exists(own, lambda s: s.isNull())
    others = present(F.flatten(F.transform(or_empty(adp), lambda a: scores(a["metrics"]))))
    chosen = F.concat(present(own), F.when(left_open, others).otherwise(F.array()))
    return F.array_distinct(F.transform(chosen, _plain_score)).cast(SCORES)


def cwe_from_problem_types(cna_types: Column, adp: Column, compat: bool = False) -> Column:
    """English CWE entries of both containers, without repeats.

    ``compat`` drops them all unless both containers describe a problem.
    """
    described = lambda types: F.filter(F.transform(or_empty(types), lambda t: t["descriptions"]),
                                       lambda d: d.isNotNull())
    own = described(cna_types)
    others = F.flatten(F.transform(or_empty(adp), lambda a: described(a["problemTypes"])))
    wanted = lambda d: (d["type"] == "CWE") & _is_english(d) & d["cweId"].isNotNull()
    entries = F.transform(
        F.filter(F.flatten(F.concat(own, others)), wanted),
        lambda d: F.struct(d["cweId"].alias("cweId"), d["description"].alias("cweDescription")))
    found = F.array_distinct(entries)
    if compat:
        found = F.when((F.size(own) > 0) & (F.size(others) > 0), found).otherwise(F.array())
    return found.cast(WEAKNESSES)


def cwe_from_weaknesses(weaknesses: Column) -> Column:
    values = F.flatten(F.transform(or_empty(weaknesses), lambda w: or_empty(w["description"])))
    return F.array_distinct(F.transform(
        F.filter(values, lambda d: _is_english(d) & d["value"].like("CWE%")),
        lambda d: F.struct(d["value"].alias("cweId"),
                           F.lit(None).cast("string").alias("cweDescription")))).cast(WEAKNESSES)


def capec_from_impacts(impacts: Column) -> Column:
    with_id = F.filter(or_empty(impacts), lambda i: i["capecId"].isNotNull())
    return F.array_distinct(F.flatten(F.transform(
        with_id,
        lambda i: F.transform(
            english_only(or_empty(i["descriptions"])),
            lambda d: F.struct(i["capecId"].alias("capecId"),
                               d["value"].alias("capecDescription")))))).cast(PATTERNS)


def cvss_from_metric_map(metrics: Column) -> Column:
    """Entries of every version key, whatever the keys are, in one pass."""
    listed = F.filter(F.map_values(metrics), lambda v: v.isNotNull())
    entry = lambda e: F.struct(
        e["source"].alias("source"), e["type"].alias("type"),
        e["cvssData"]["version"].alias("version"),
        e["cvssData"]["vectorString"].alias("vectorString"),
        e["cvssData"]["baseScore"].alias("baseScore"),
        e["impactScore"].alias("impactScore"),
        e["exploitabilityScore"].alias("exploitabilityScore"))
    present = F.filter(F.flatten(listed), lambda e: e.isNotNull())
    return F.coalesce(F.array_distinct(F.transform(present, entry)), F.array()).cast(SCORES)


def cwe_union(entries: Column) -> Column:
    """One entry per CWE id with its greatest description."""
    ids = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["cweId"])))
    return F.transform(ids, lambda i: F.struct(
        i.alias("cweId"),
        F.array_max(F.transform(F.filter(entries, lambda e: e["cweId"] == i),
                                lambda e: e["cweDescription"])).alias("cweDescription")))


def collect_distinct_flat(arr: Column) -> Column:
    """Aggregate: union of a group's arrays in a fixed order.

    The set drops equal arrays before the shuffle, so copies of a row cost nothing; one
    distinct array keeps its own order.
    """
    return F.array_distinct(F.flatten(F.array_sort(F.collect_set(arr))))
