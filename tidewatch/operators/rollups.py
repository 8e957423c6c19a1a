"""Daily, monthly and year-to-date rollups at three levels, and running totals."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, scoring
from ..session import cut_lineage

LEVEL_KEYS = {"global": [], "vendor": ["vendor"], "product": ["vendor", "product"]}
GRAIN_KEYS = {
    "daily": ["year_published", "date_published"],
    "monthly": ["year_published", "month_published"],
    "ytd": ["year_published"],
}
ALL_VIEWS = [f"{grain}_{level}" for grain in GRAIN_KEYS for level in LEVEL_KEYS]
MEASURES = ["total_cves", "threat_index", "critical_count", "high_count", "medium_count",
            "low_count", "network_threat_index", "network_cves", "no_ui_cves", "low_priv_cves",
            "fully_critical_cves"]
CONDITIONS = {
    "critical_count": "severity = 'Critical'",
    "high_count": "severity = 'High'",
    "medium_count": "severity = 'Medium'",
    "low_count": "severity = 'Low'",
    "network_cves": "is_network_based",
    "no_ui_cves": "is_no_ui",
    "low_priv_cves": "is_low_priv",
    "fully_critical_cves": "is_fully_critical",
}
#: Rows that a task makes distinct for all views at a time; in memory some 250 MB.
ROWS_PER_TASK = 250_000


def view_keys(view: str, compat: bool = False) -> list[str]:
    """Grouping columns of a view such as ``monthly_vendor``."""
    grain, level = view.split("_")
    exact = ["datePublished"] if compat and grain == "daily" else []
    return LEVEL_KEYS[level] + GRAIN_KEYS[grain] + exact


def common_aggs() -> list[Column]:
    """Distinct CVEs per condition and sums over distinct weights.

    FILTER clauses share one distinct column, so Spark expands each row twice (id, weight) and
    not once per measure; ids and weights are de-duplicated before and after the shuffle.
    """
    counted = {name: F.expr(f"count(DISTINCT cveId) FILTER (WHERE {when})")
               for name, when in CONDITIONS.items()}
    measures = {
        "total_cves": F.expr("count(DISTINCT cveId)"),
        "threat_index": scoring.from_units(F.expr("sum(DISTINCT weight_units)")),
        "network_threat_index": scoring.from_units(
            F.expr("sum(DISTINCT weight_units) FILTER (WHERE is_network_based)")),
    } | counted
    return [measures[name].alias(name) for name in MEASURES]


def _aggs_by_id() -> list[Column]:
    """The same measures over rows that already hold one CVE each."""
    counted = {name: F.count_if(F.expr(when)) for name, when in CONDITIONS.items()}
    measures = {
        "total_cves": F.count("cveId"),
        "threat_index": scoring.from_units(F.sum("weight_units")),
        "network_threat_index": scoring.from_units(
            F.sum(F.when(F.col("is_network_based"), F.col("weight_units")))),
    } | counted
    return [measures[name].alias(name) for name in MEASURES]


def calendar_base(enriched: DataFrame) -> DataFrame:
    """Only what the rollups need, with calendar columns and integer weights."""
    return (dates.date_parts(enriched)
            .withColumn("weight_units", scoring.weight_units(F.col("weighted_score"))))


def finish(df: DataFrame, view: str) -> DataFrame:
    """The calendar columns and the rating of a view."""
    grain, level = view.split("_")
    if grain == "daily":
        for missing in {"global": ["vendor", "product"], "vendor": ["product"]}.get(level, []):
            df = df.withColumn(missing, F.lit(None).cast("string"))
    elif grain == "monthly":
        df = df.withColumn("month_date", dates.month_date())
    else:
        df = df.withColumn("year_date", dates.year_date())
    return df.withColumn("risk_rating", scoring.risk_rating(F.col("threat_index"), view))


def rollup(enriched: DataFrame, view: str, dedupe: str = "weight",
           compat: bool = False) -> DataFrame:
    """One of the nine views.

    The index adds each distinct weight once, so two CVEs of equal weight count once;
    ``dedupe='id'`` adds the greatest weight of every CVE instead. ``compat`` groups the daily
    views by exact publish time rather than by day.
    """
    keys = view_keys(view, compat)
    base = calendar_base(enriched)
    if dedupe == "id":
        flags = ["is_network_based", "is_no_ui", "is_low_priv", "is_fully_critical"]
        per_cve = (base.groupBy(*keys, "cveId")
                   .agg(F.max_by("severity", "weight_units").alias("severity"),
                        F.max("weight_units").alias("weight_units"),
                        *[F.max(f).alias(f) for f in flags]))
        return finish(per_cve.groupBy(*keys).agg(*_aggs_by_id()), view)
    return finish(base.groupBy(*keys).agg(*common_aggs()), view)


def mark_alone(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``_alone``: whether no other row has the same ``keys``.

    Rows dealt out by (some of) the keys stay where they are. A hash leads the sort, as Spark compares
    numbers faster than texts; equal hashes of different keys are told apart by the keys.
    """
    same = Window.partitionBy("_hash", *keys)
    return (rows.withColumn("_hash", F.xxhash64(*keys))
            .withColumn("_alone", F.count(F.lit(1)).over(same) == 1).drop("_hash"))


def rollups(enriched: DataFrame, views: list[str] = ALL_VIEWS) -> DataFrame:
    """Several views from one scan, tagged with ``level``.

    Keys that a view does not group by are NULL. ``split_view`` gives a single view its shape.

    What the views need is written once. Rows are then dealt out by id alone, ``ROWS_PER_TASK`` to a
    task, so that each task finds the distinct ids of all keys of all views without another shuffle
    and passes on no more than counts. An id with one product and day counts once in every view, so it
    is counted there and only the counts go to the views; ids of several are made distinct for each
    view. Weights are made distinct per day before they go to the views.
    """
    base = calendar_base(enriched)
    bits = reduce(Column.__add__, [F.when(F.expr(when), 1 << i).otherwise(0)
                                   for i, when in enumerate(CONDITIONS.values())])
    base = cut_lineage(base.select("vendor", "product", "date_published", "cveId", "weight_units",
                                   bits.alias("_bits")), "rollup-rows")
    has = lambda name: F.col("_bits").bitwiseAND(1 << list(CONDITIONS).index(name)) != 0
    tasks = base.count() // ROWS_PER_TASK + 1
    columns = ["vendor", "product", "year_published", "month_published", "date_published"]
    source = dict(zip(columns, [F.col("vendor"), F.col("product"), F.year("date_published"),
                                F.month("date_published"), F.col("date_published")]))
    kinds = dict(zip(columns, ["string", "string", "int", "int", "date"]))

    entries = lambda of: F.array(*[F.struct(
        F.lit(view).alias("level"),
        *[(of[c] if c in view_keys(view) else F.lit(None).cast(kinds[c])).alias(c) for c in columns])
        for view in views])
    whole = F.struct(F.lit(None).cast("string").alias("level"), *[source[c].alias(c) for c in columns])
    keys = ["level", *columns]

    def spread(rows: DataFrame, found: Column, *others: str) -> DataFrame:
        return rows.select(*others, F.explode(found).alias("_k")).select("_k.*", *others)

    fine_keys = ["vendor", "product", "date_published"]
    ids = (base.where("cveId IS NOT NULL").repartition(tasks, "cveId").groupBy("cveId", *fine_keys)
           .agg(F.bit_or("_bits").alias("_bits")))
    # no level as yet where an id has one product and day
    ids = spread(mark_alone(ids, ["cveId"]), F.when(F.col("_alone"), F.array(whole)).otherwise(entries(source)),
                 "cveId", "_bits").groupBy(*keys, "cveId").agg(F.bit_or("_bits").alias("_bits"))
    counted = {"total_cves": F.count("*"), **{c: F.count_if(has(c)) for c in CONDITIONS}}
    ids = ids.groupBy(*keys).agg(*[c.alias(n) for n, c in counted.items()])
    stored = {c: F.col(c) for c in columns}
    here = F.array(F.struct(*[F.col(k) for k in keys]))
    ids = spread(ids, F.when(F.col("level").isNull(), entries(stored)).otherwise(here), *counted)
    fine = base.groupBy(*fine_keys, "weight_units").agg(F.bit_or("_bits").alias("_bits"))
    weights = (spread(fine, entries(source), "weight_units", "_bits")
               .groupBy(*keys, "weight_units").agg(F.bit_or("_bits").alias("_bits")).groupBy(*keys).agg(
                   F.sum("weight_units").alias("_all"),
                   F.sum(F.when(has("network_cves"), F.col("weight_units"))).alias("_network")))
    # a key has rows of either kind, of ids none where all are NULL
    nothing = lambda df, names: df.withColumns({n: F.lit(None).cast("bigint") for n in names})
    both = (nothing(ids, ["_all", "_network"])
            .unionByName(nothing(weights, list(counted))).groupBy(*keys)
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted],
                 F.sum("_all").alias("_all"), F.sum("_network").alias("_network")))
    measures = {"threat_index": scoring.from_units(F.col("_all")),
                "network_threat_index": scoring.from_units(F.col("_network"))}
    return both.select(*columns, *[measures.get(m, F.col(m)).alias(m) for m in MEASURES], "level")


def named_sets(grouped: DataFrame, set_id: str, columns: list[str], sets: dict[str, list[str]],
               name: str) -> DataFrame:
    """``grouped`` with the name of the grouping set of each row in place of its ``grouping_id``."""
    number = lambda keys: sum(1 << (len(columns) - 1 - i)
                              for i, c in enumerate(columns) if c not in keys)
    names = F.create_map(*[F.lit(x) for n, keys in sets.items() for x in (number(keys), n)])
    return grouped.withColumn(name, F.try_element_at(names, F.col(set_id).cast("int"))).drop(set_id)


def split_view(tagged: DataFrame, view: str) -> DataFrame:
    return finish(tagged.filter(F.col("level") == view).select(*view_keys(view), *MEASURES), view)


def running_total(daily: DataFrame, level: str, order: str = "date_published",
                  block: str | None = None) -> DataFrame:
    """Cumulative index per level key, over all years, with its rating.

    The sum runs over whole hundredths, so it is exact. After the daily rollup a key has at most
    one row per calendar day, which bounds the window of the global level too. For finer grains
    name a coarser ``block`` column: each block is summed in its own task and then shifted by the
    total of the earlier blocks.
    """
    keys = LEVEL_KEYS[level]
    cents = _cents()
    upto_here = (Window.partitionBy(*keys, *([block] if block else []))
                 .orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = daily.withColumn("_sum", F.sum(cents).over(upto_here))
    if block:
        before = (Window.partitionBy(*keys).orderBy(block)
                  .rowsBetween(Window.unboundedPreceding, -1))
        offsets = (daily.groupBy(*keys, block).agg(F.sum(cents).alias("_block"))
                   .withColumn("_before", F.coalesce(F.sum("_block").over(before), F.lit(0)))
                   .drop("_block"))
        same = reduce(lambda a, b: a & b,
                      [summed[k].eqNullSafe(offsets[k]) for k in [*keys, block]])
        summed = (summed.join(offsets, same, "left")
                  .select(*[summed[c] for c in daily.columns],
                          (F.col("_sum") + F.col("_before")).alias("_sum")))
    return _rated(summed, level, F.col("_sum")).drop("_sum")


def _cents() -> Column:
    return F.round(F.col("threat_index") * 100).cast("bigint")


def _rated(df: DataFrame, level: str, total: Column) -> DataFrame:
    return (df.withColumn("cumulative_threat_index", total / F.lit(100.0))
              .withColumn("running_risk_rating", scoring.risk_rating(
                  F.col("cumulative_threat_index"), f"ytd_{level}")))


def year_totals(daily: DataFrame, level: str) -> DataFrame:
    """(level keys, year_published, cents): what each year adds to the running total of a key."""
    return daily.groupBy(*LEVEL_KEYS[level], "year_published").agg(F.sum(_cents()).alias("cents"))


def running_total_from(daily: DataFrame, years: DataFrame, level: str,
                       start: date | None) -> DataFrame:
    """The rows of ``running_total`` from day ``start`` on, or all of them where it is None.

    ``years`` are the ``year_totals`` of the whole view. Totals of earlier years come from there, so
    of ``daily`` only the year of ``start`` and later ones are read; undated rows count as earlier.
    """
    if start is None:
        return running_total(daily, level)
    keys = LEVEL_KEYS[level]
    year, day = F.col("year_published"), F.col("date_published")
    rows = daily.filter(year >= start.year)
    before = (years.filter(year.isNull() | (year < start.year)).select(*keys, "cents")
              .unionByName(rows.filter(day < F.lit(start)).select(*keys, _cents().alias("cents")))
              .groupBy(*keys).agg(F.sum("cents").alias("_before")))
    upto = (Window.partitionBy(*keys).orderBy("date_published")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = rows.filter(day >= F.lit(start)).withColumn("_sum", F.sum(_cents()).over(upto))
    if keys:
        same = reduce(Column.__and__, [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
        summed = summed.alias("d").join(before.alias("b"), same, "left").select("d.*", "_before")
    else:
        summed = summed.withColumn("_before", before.scalar())
    total = F.coalesce(F.col("_before") + F.coalesce("_sum", F.lit(0)), F.col("_sum"))
    return _rated(summed, level, total).drop("_sum", "_before")
