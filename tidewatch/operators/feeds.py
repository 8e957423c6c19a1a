"""Raw feed records to one staging row per (vendor, product, CVE, pull)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested, text
from ..schemas import CNA_DOCUMENT, KEYS, NVD_DOCUMENT, STAGING_COLUMNS

PULL = ["ingestionTimestamp", "ingestionDate"]


def availability_flag(df: DataFrame, *feeds: str) -> DataFrame:
    """True where at least one feed array has entries."""
    filled = F.lit(False)
    for feed in feeds or ("cvelistv5", "fkie_nvd"):
        filled = filled | (F.coalesce(F.size(feed), F.lit(0)) > 0)
    return df.withColumn("cveDataAvailable", filled)


def available_only(df: DataFrame, flag: str = "cveDataAvailable") -> DataFrame:
    return df.filter(F.col(flag)).drop(flag)


def _parsed(text_column: str, schema: str) -> Column:
    """Parse as the output of a generator.

    Filters are not pushed below a generator, so a later filter on the document does not make
    Spark parse it a second time.
    """
    return F.explode(F.array(F.from_json(text_column, schema)))


def parse_pairs(df: DataFrame, pairs: str, schema: str, id_name: str = "cveId") -> DataFrame:
    """One row per ``[id, json]`` pair, the document parsed as ``details``."""
    others = [c for c in df.columns if c != pairs]
    return (df.select(*others, F.explode(pairs).alias("_pair"))
              .select(*others, F.get("_pair", F.lit(0)).alias(id_name),
                      F.get("_pair", F.lit(1)).alias("_text"))
              .select(*others, id_name, _parsed("_text", schema).alias("details")))


def cna_columns(doc: Column, compat: bool = False) -> dict[str, Column]:
    """Staging columns of a CNA/ADP document, computed inside the row."""
    meta, cna, adp = doc["cveMetadata"], doc["containers"]["cna"], doc["containers"]["adp"]
    return {
        "datePublished": text.iso_timestamp(meta["datePublished"]),
        "dateReserved": text.iso_timestamp(meta["dateReserved"]),
        "dateUpdated": text.iso_timestamp(meta["dateUpdated"]),
        "datePublic": text.iso_timestamp(cna["datePublic"]),
        "alt_description": nested.first_english(cna["descriptions"]),
        "alt_cvssData": nested.alt_cvss(cna["metrics"], adp),
        "alt_capecData": nested.capec_from_impacts(cna["impacts"]),
        "alt_cweData": nested.cwe_from_problem_types(cna["problemTypes"], adp, compat),
    }


def nvd_columns(doc: Column) -> dict[str, Column]:
    """Staging columns of an NVD document."""
    return {
        "published": text.iso_timestamp(doc["published"]),
        "lastModified": text.iso_timestamp(doc["lastModified"]),
        "vulnStatus": doc["vulnStatus"],
        "Descriptions": nested.first_english(doc["descriptions"]),
        "cvssData": nested.cvss_from_metric_map(doc["metrics"]),
        "fkie_cweData": nested.cwe_from_weaknesses(doc["weaknesses"]),
    }


def _with_key(df: DataFrame, ident: Column, columns: dict[str, Column]) -> DataFrame:
    kept = [c for c in df.columns if c not in ("cveId", "details")]
    return df.select(*kept, ident.alias("cveId"), *[c.alias(n) for n, c in columns.items()])


def flatten_cna_adp(parsed: DataFrame, compat: bool = False) -> DataFrame:
    """``parse_pairs`` output of the CNA feed to flat columns, one row per document."""
    return _with_key(parsed, text.normalize_id(F.col("cveId")),
                     cna_columns(F.col("details"), compat))


def flatten_nvd(parsed: DataFrame, compat: bool = False) -> DataFrame:
    """``parse_pairs`` output of the NVD feed to flat columns.

    Documents without an English description are left out. ``compat`` also leaves out those
    without a score, and does not normalise the id.
    """
    doc = F.col("details")
    ident = doc["id"] if compat else text.normalize_id(doc["id"])
    kept = parsed.filter(F.exists(doc["descriptions"], lambda d: d["lang"].like("en%")))
    flat = _with_key(kept, ident, nvd_columns(doc))
    return flat.filter(F.size("cvssData") > 0) if compat else flat


def feed_documents(raw: DataFrame, compat: bool = False) -> DataFrame:
    """Documents of both feeds in one pass over the raw records.

    Columns that belong to the other feed are NULL. ``usable`` is false for NVD documents that
    ``flatten_nvd`` leaves out; they are dropped when pulls are collapsed, because a filter here
    would be pushed down and parse every document twice.
    """
    tagged = lambda feed: F.transform(
        nested.or_empty(F.col(feed)),
        lambda p: F.struct(F.lit(feed).alias("feed"), F.get(p, F.lit(0)).alias("id"),
                           F.get(p, F.lit(1)).alias("text")))
    items = raw.select("vendor", "product", *PULL,
                       F.explode(F.concat(tagged("cvelistv5"), tagged("fkie_nvd"))).alias("item"))
    is_cna = F.col("item.feed") == "cvelistv5"
    parsed = items.select(
        "vendor", "product", *PULL, F.col("item.id").alias("pair_id"), is_cna.alias("is_cna"),
        F.when(is_cna, F.from_json("item.text", CNA_DOCUMENT)).alias("cna"),
        F.when(~is_cna, F.from_json("item.text", NVD_DOCUMENT)).alias("nvd"))
    nvd_id = F.col("nvd.id") if compat else text.normalize_id(F.col("nvd.id"))
    usable = F.col("is_cna") | F.exists("nvd.descriptions", lambda d: d["lang"].like("en%"))
    columns = cna_columns(F.col("cna"), compat) | nvd_columns(F.col("nvd"))
    rows = parsed.select(
        "vendor", "product", *PULL,
        F.when(F.col("is_cna"), text.normalize_id(F.col("pair_id"))).otherwise(nvd_id)
         .alias("cveId"),
        "is_cna", F.coalesce(usable, F.lit(False)).alias("usable"),
        *[c.alias(n) for n, c in columns.items()])
    if compat:
        rows = rows.withColumn(
            "usable", F.col("usable") & (F.col("is_cna") | (F.size("cvssData") > 0)))
    return rows


def collapse_pulls(documents: DataFrame) -> DataFrame:
    """One row per key and pull.

    Scalars come together from the newest document of a feed (greatest modification time, then
    the remaining fields as tie-breakers); scores and weaknesses are united.
    """
    cna, nvd = F.col("is_cna"), ~F.col("is_cna") & F.col("usable")
    newest_cna = F.struct("dateUpdated", "datePublished", "dateReserved", "datePublic",
                          "alt_description", "alt_capecData")
    newest_nvd = F.struct("lastModified", "published", "vulnStatus", "Descriptions")
    collapsed = documents.groupBy(*KEYS, *PULL).agg(
        F.max(F.when(cna, newest_cna)).alias("cna"),
        F.max(F.when(nvd, newest_nvd)).alias("nvd"),
        nested.collect_distinct_flat(F.when(cna, F.col("alt_cvssData"))).alias("cna_scores"),
        nested.collect_distinct_flat(F.when(nvd, F.col("cvssData"))).alias("nvd_scores"),
        nested.collect_distinct_flat(
            F.when(cna, F.col("alt_cweData")).when(nvd, F.col("fkie_cweData"))).alias("cwe"))
    return collapsed.filter("cna IS NOT NULL OR nvd IS NOT NULL")


def merge_pulls(pulls: DataFrame) -> DataFrame:
    """Staging rows: full outer merge of the two feeds per key.

    Every CNA pull takes the key's NVD data, from whichever pull it came; keys that only NVD
    knows keep one row per pull. ``pulls`` is read twice: cut its lineage first on big input.

    Only keys with several pulls have anything to share, so only those are joined back: few
    enough to be broadcast as a rule. Grouping by one struct leaves the small side without the
    join's partitioning; it gets a shuffle of its own, which lets AQE split a hot key.
    """
    shared = (pulls.groupBy(F.struct(*KEYS).alias("key")).agg(
        F.count("*").alias("pulls"),
        F.max("nvd").alias("key_nvd"),
        nested.collect_distinct_flat(F.col("nvd_scores")).alias("key_scores"),
        nested.cwe_union(nested.collect_distinct_flat(F.col("cwe"))).alias("key_cwe"),
        F.max(F.col("cna").isNotNull()).alias("key_has_cna"))
        .filter("pulls > 1").select("key.*", "key_nvd", "key_scores", "key_cwe", "key_has_cna"))
    has_cna = F.col("cna").isNotNull()
    nvd = F.when(has_cna, F.coalesce("key_nvd", "nvd")).otherwise(F.col("nvd"))
    nvd_scores = F.when(has_cna, F.coalesce("key_scores", "nvd_scores")).otherwise(
        F.col("nvd_scores"))
    return (
        pulls.join(shared, KEYS, "left")
        .filter(has_cna | ~F.coalesce("key_has_cna", F.lit(False)))
        .withColumn("nvd", nvd)
        .select(
            "ingestionDate", *KEYS,
            nested.empty_to_null(F.coalesce("key_cwe", nested.cwe_union(F.col("cwe"))))
                  .alias("cweData"),
            nested.empty_to_null(F.col("cna.alt_capecData")).alias("capecData"),
            "nvd.vulnStatus",
            F.coalesce(nested.empty_to_null(nvd_scores),
                       F.when(has_cna, nested.empty_to_null(F.col("cna_scores"))))
             .alias("cvssData"),
            F.coalesce("cna.datePublished", "nvd.published").alias("datePublished"),
            "cna.dateReserved", "cna.dateUpdated", "cna.datePublic", "nvd.lastModified",
            text.strip_tags(F.coalesce("nvd.Descriptions", "cna.alt_description"))
                .alias("Descriptions"),
            "ingestionTimestamp")
        .select(*STAGING_COLUMNS))


def stage(raw: DataFrame, compat: bool = False,
          cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Raw records to staging rows. ``cut`` may materialise the collapsed pulls."""
    return merge_pulls(cut(collapse_pulls(feed_documents(raw, compat))))


def dedupe_then_collect(df: DataFrame, keys: list[str], ident: str = "cweId",
                        label: str = "cweDescription", alias: str = "cweData") -> DataFrame:
    """Long form: one label per (key, id), then the key's sorted (id, label) pairs."""
    return (df.groupBy(*keys, ident).agg(F.max(label).alias(label))
              .groupBy(*keys)
              .agg(F.array_sort(F.collect_list(F.struct(ident, label))).alias(alias)))


def collapse_chunks(df: DataFrame, keys: list[str], order_by: list[str], scalars: list[str],
                    arrays: list[str]) -> DataFrame:
    """One row per key: scalars of the first row by ``order_by``, united arrays."""
    first = F.min(F.struct(*order_by, *[F.col(c).alias(f"_{c}") for c in scalars]))
    return (df.groupBy(*keys)
              .agg(first.alias("_first"),
                   *[nested.collect_distinct_flat(F.col(a)).alias(a) for a in arrays])
              .select(*keys, *[F.col(f"_first._{c}").alias(c) for c in scalars], *arrays))


def map_key_list(df: DataFrame, column: str, alias: str = "key") -> DataFrame:
    """Distinct keys of a map column."""
    return df.select(F.explode(F.map_keys(column)).alias(alias)).distinct()
