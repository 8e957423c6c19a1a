"""Severity, weights, vector parsing and risk ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SCORES

# Lowest score of each severity band.
SEVERITY_FLOORS = {"Critical": 9.0, "High": 7.0, "Medium": 4.0}
# Weight of each severity.
SEVERITY_WEIGHTS = {"Critical": 1.0, "High": 0.75, "Medium": 0.5, "Low": 0.25}
# An index strictly above the bound earns the rating.
RATINGS = ["Critical", "High", "Moderate", "Low"]
LADDERS = {
    "daily_global": [9, 7, 4, 1],
    "daily_vendor": [7, 6, 4, 1],
    "daily_product": [7, 7, 5, 1],
    "monthly_global": [244, 137, 95, 1],
    "monthly_vendor": [10, 7, 4, 1],
    "monthly_product": [11, 7, 5, 1],
    "ytd_global": [293, 236, 175, 1],
    "ytd_vendor": [10, 7, 5, 1],
    "ytd_product": [12, 8, 5, 1],
}

# Weights are summed as whole millionths: exact, and independent of row order.
UNITS = 1_000_000


def severity(score: Column, missing: str | None = None) -> Column:
    """Band of a score; ``missing`` for rows without a score."""
    banded = F.when(score.isNull(), F.lit(missing).cast("string"))
    for name, floor in SEVERITY_FLOORS.items():
        banded = banded.when(score >= floor, name)
    return banded.otherwise("Low")


def weighted_score(score: Column, band: Column) -> Column:
    weight = F.lit(None).cast("double")
    for name, factor in reversed(SEVERITY_WEIGHTS.items()):
        weight = F.when(band == name, F.lit(factor)).otherwise(weight)
    return F.coalesce(score * weight, F.lit(0.0))


def weight_units(weight: Column) -> Column:
    return F.round(weight * UNITS).cast("bigint")


def from_units(units: Column, scale: int = 2) -> Column:
    return F.round(units / F.lit(float(UNITS)), scale)


def risk_rating(index: Column, level: str) -> Column:
    rated = F.when(index.isNull(), "Unknown")
    for name, bound in zip(RATINGS, LADDERS[level]):
        rated = rated.when(index > bound, name)
    return rated.otherwise("None")


def vector_metric(vector: Column, metric: str, compat: bool = False) -> Column:
    """Value of one vector component, '' when absent.

    ``compat`` searches anywhere in the text, so ``C`` also hits ``AC``.
    """
    start = "" if compat else "(?:^|/)"
    return F.regexp_extract(vector, f"{start}{metric}:([^/]+)", 1)


def cvss_vector(vector: Column, version: Column, compat: bool = False) -> dict[str, Column]:
    """All components; the v3 ones are blank for version 2.0 and the other way round."""
    part = lambda m: vector_metric(vector, m, compat)
    columns = {m: part(m) for m in ("AV", "AC", "C", "I", "A")}
    columns |= {m: F.when(version != "2.0", part(m)).otherwise("") for m in ("PR", "UI", "S")}
    columns["Au"] = F.when(version == "2.0", part("Au")).otherwise("")
    return columns


def metric_is(padded: Column, metric: str, value: str) -> Column:
    """Whether a component has a value, without a regex.

    ``padded`` is the vector between two slashes; the first of a repeated component counts.
    """
    wanted = f"/{metric}:{value}/"
    at = F.instr(padded, f"/{metric}:")
    return F.substr(padded, at, F.lit(len(wanted))) == wanted


def component_flags(padded: Column, version: Column, compat: bool = False) -> dict[str, Column]:
    """Seven never-null booleans of a vector between slashes.

    ``compat`` looks components up anywhere in the text, as ``vector_metric`` does.
    """
    def is_(metric: str, value: str) -> Column:
        if compat:
            return vector_metric(padded, metric, compat) == value
        return metric_is(padded, metric, value)

    v2, v3 = version == "2.0", version != "2.0"
    anonymous = v2 & is_("Au", "N")
    flags = {
        "is_network_based": is_("AV", "N"),
        "is_no_ui": (v3 & is_("UI", "N")) | anonymous,
        "is_low_priv": (v3 & (is_("PR", "L") | is_("PR", "N"))) | anonymous,
        "is_scope_changed": v3 & is_("S", "C"),
        "is_high_conf": is_("C", "H"),
        "is_high_int": is_("I", "H"),
        "is_high_avail": is_("A", "H"),
    }
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}


def fully_critical(version: Column) -> Column:
    """The eighth flag, from the columns that the other seven became."""
    flag = lambda name: F.col(f"is_{name}")
    return F.coalesce(
        flag("network_based") & flag("no_ui") & flag("low_priv")
        & (flag("scope_changed") | (version == "2.0"))
        & (flag("high_conf") | flag("high_int") | flag("high_avail")), F.lit(False))


def best_entry(scores: Column) -> Column:
    """Entry with the highest base score, the first one on ties.

    No entries at all give a blank entry; entries without any score give NULL.
    """
    top = F.array_max(F.transform(scores, lambda s: s["baseScore"]))
    best = F.get(F.filter(scores, lambda s: s["baseScore"] == top), 0)
    blank = F.struct(
        *[F.lit("").alias(n) for n in ("source", "type", "version", "vectorString")],
        *[F.lit(None).cast("double").alias(n)
          for n in ("baseScore", "impactScore", "exploitabilityScore")],
    )
    entry_type = SCORES.removeprefix("array<").removesuffix(">")
    return F.when(F.coalesce(F.size(scores), F.lit(0)) <= 0, blank.cast(entry_type)).otherwise(best)
