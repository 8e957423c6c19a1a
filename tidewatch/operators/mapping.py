"""Key -> id sets, their snapshots and the change feed.

Sets are kept in long form, one row per (vendor, product, id): a popular key may own a large
share of all ids and must not become one array in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import nested, text
from .prefix import running_sums

MAP_KEYS = ["vendor", "product"]
#: Rows of a build that a task makes distinct at a time.
ROWS_PER_TASK = 250_000


def cpe_pairs(docs: DataFrame) -> DataFrame:
    """(vendor, product, cve) of every platform criterion of an NVD document."""
    per_config = lambda c: F.flatten(F.transform(
        nested.or_empty(c["nodes"]), lambda n: nested.or_empty(n["cpeMatch"])))
    matches = F.flatten(F.transform(nested.or_empty(F.col("configurations")), per_config))
    return (docs.select(F.col("id").alias("cve"), F.explode(matches).alias("m"))
                .select(text.cpe_part(F.col("m.criteria"), 3).alias("vendor"),
                        text.cpe_part(F.col("m.criteria"), 4).alias("product"), "cve"))


def affected_pairs(docs: DataFrame) -> DataFrame:
    """(vendor, product, cve) of every affected entry of a CNA document."""
    affected = nested.or_empty(F.col("containers.cna.affected"))
    return (docs.select(F.col("cveMetadata.cveId").alias("cve"), F.explode(affected).alias("a"))
                .select("a.vendor", "a.product", "cve"))


def cpe_hierarchy(df: DataFrame, name: str = "cpeName") -> DataFrame:
    """Distinct (set_key, member) rows: prefix -> type -> vendor -> product -> version suffix.

    Part 1 of a platform name is its version and belongs to no set. A colon after a backslash is
    part of a name.
    """
    parts = F.split(name, r"(?<!\\):")
    at = lambda i: F.get(parts, F.lit(i))
    suffix = F.array_join(F.slice(parts, 6, F.greatest(F.size(parts) - 5, F.lit(0))), ":")
    edge = lambda key, member: F.struct(key.alias("set_key"), member.alias("member"))
    edges = F.array(
        edge(F.concat(F.lit("prefix:"), at(0)), at(2)),
        edge(at(2), at(3)),
        edge(F.concat(F.lit("v:"), at(3)), at(4)),
        edge(F.concat(F.lit("p:"), at(4)), F.nullif(suffix, F.lit(""))))
    return (df.select(F.explode(edges).alias("e")).select("e.*")
              .filter("set_key IS NOT NULL AND member IS NOT NULL").distinct())


def tasks_for(pairs: DataFrame) -> int:
    """Number of tasks among which ``id_pairs`` deals out these rows."""
    return pairs.count() // ROWS_PER_TASK + 1


def id_pairs(pairs: DataFrame, build_ts: Column, tags: list[str] = (),
             tasks: int | None = None) -> DataFrame:
    """Cleaned, distinct (vendor, product, cve) rows of one build, with the columns ``tags``.

    Keys are cleaned before they are grouped, so spellings of one key share a set. Rows are dealt out
    by key and id among ``tasks``, or as many as their number asks for: what a task holds in memory
    does not grow with the build. Builds dealt out among as many tasks are compared without another
    shuffle.
    """
    cleaned = pairs.select(text.clean_key(F.col("vendor")).alias("vendor"),
                           text.clean_key(F.col("product")).alias("product"), "cve", *tags)
    return (cleaned.dropna(subset=[*MAP_KEYS, "cve"])
                   .repartition(tasks or tasks_for(pairs), *MAP_KEYS, "cve").distinct()
                   .withColumn("build_ts", build_ts))


def pack_id_sets(pairs: DataFrame, per_row: int = 1_000) -> DataFrame:
    """Long form to sorted arrays of ``per_row`` ids; big keys span several chunks, in order of ids.

    Chunks put end to end give the ids of a key in order. Ids are numbered by prefix sums over
    ranges and grouped by chunk, so no task sees a big key as a whole.
    """
    return _packed(pairs, F.lit(1), per_row)


def pack_by_bytes(pairs: DataFrame, docs: DataFrame, max_bytes: int, ident: str = "cve",
                  body: str = "document") -> DataFrame:
    """As ``pack_id_sets``, for the documents of the ids: a chunk's ids and bodies stay within
    ``max_bytes`` where no document has more than half of that, and else exceed half of it by no more
    than one document.

    Cut points come from prefix sums of sizes; the documents themselves are not moved. Ids without a
    document are left out.
    """
    size = F.octet_length(F.col(ident).cast("string")) + F.coalesce(F.octet_length(body), F.lit(0))
    sized = pairs.join(docs.select(ident, size.cast("bigint").alias("_bytes")), ident)
    return _packed(sized, F.col("_bytes"), max(1, max_bytes // 2), ident)


def _packed(pairs: DataFrame, amount: Column, limit: int, ident: str = "cve") -> DataFrame:
    """A new chunk begins where the amounts before an id pass a multiple of ``limit``."""
    keys = [*MAP_KEYS, "build_ts"]
    rows = pairs.select(*keys, ident, amount.cast("bigint").alias("_amount"))
    placed = running_sums(rows, keys, [ident], {"_upto": F.col("_amount")})
    chunk = F.floor((F.col("_upto") - F.col("_amount")) / limit).cast("bigint")
    return (placed.withColumn("chunk", chunk).groupBy(*keys, "chunk")
            .agg(F.array_sort(F.collect_list(ident)).alias("cves")))


def build_meta(pairs: DataFrame, collection: str, meta: DataFrame | None = None) -> DataFrame:
    """Number of keys per build; builds that ``meta`` already lists are left out."""
    built = (pairs.select(*MAP_KEYS, "build_ts").distinct()
             .groupBy("build_ts").agg(F.count("*").alias("count"))
             .select(F.lit(collection).alias("collection"), F.col("build_ts").alias("ts"),
                     "count"))
    return built if meta is None else built.join(meta, ["collection", "ts"], "left_anti")


def browse_vendors(*maps: DataFrame) -> DataFrame:
    """Sorted vendors of all maps."""
    every = reduce(DataFrame.unionByName, [m.select("vendor") for m in maps])
    return every.dropna().distinct().orderBy("vendor")


def browse_products(vendor: str, *maps: DataFrame) -> DataFrame:
    """Sorted products of one vendor."""
    every = reduce(DataFrame.unionByName,
                   [m.filter(F.col("vendor") == vendor).select("product") for m in maps])
    return every.dropna().distinct().orderBy("product")


def browse_lists(vendor: str, *maps: DataFrame) -> DataFrame:
    """(kind, name): all vendors, and the products of one of them, from one pass over the maps."""
    every = reduce(DataFrame.unionByName, [m.select(*MAP_KEYS) for m in maps])
    entry = lambda kind, name: F.struct(F.lit(kind).alias("kind"), F.col(name).alias("name"))
    wanted = F.when(F.col("vendor") == vendor, F.array(entry("vendor", "vendor"), entry("product", "product")))
    return (every.select(F.explode(wanted.otherwise(F.array(entry("vendor", "vendor")))).alias("e"))
            .select("e.*").filter("name IS NOT NULL").distinct())


def newest_build(meta: DataFrame, collection: str) -> DataFrame:
    return meta.filter(F.col("collection") == collection).agg(F.max("ts").alias("ts"))


def baseline_build(meta: DataFrame, collection: str, now: Column, hours: float) -> DataFrame:
    """Newest build at least ``hours`` old, else the oldest one; fails below two builds."""
    cutoff = now - F.make_dt_interval(secs=F.lit(float(hours) * 3600))
    found = meta.filter(F.col("collection") == collection).agg(
        F.count("*").alias("builds"),
        F.coalesce(F.max(F.when(F.col("ts") <= cutoff, F.col("ts"))), F.min("ts")).alias("ts"))
    too_few = F.raise_error(F.lit(f"need at least 2 builds of {collection}"))
    return found.select(F.when(F.col("builds") < 2, too_few.cast("timestamp"))
                         .otherwise(F.col("ts")).alias("ts"))


def snapshot(pairs: DataFrame, build: DataFrame) -> DataFrame:
    """The rows of one build; ``build`` is a one-row frame with ``ts``."""
    return pairs.filter(F.col("build_ts") == build.scalar())


def snapshot_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Keys whose id set differs, with the number of added and removed ids.

    Both snapshots are laid on top of each other and grouped by key *and* id, so that a key of any
    size spreads over all tasks, and keys that vanished are seen too. Snapshots that ``id_pairs``
    dealt out among as many tasks are grouped where they are, others take one shuffle.
    """
    side = lambda df, is_new: df.select(*MAP_KEYS, "cve", F.lit(is_new).alias("_new"))
    found = (side(new, True).unionByName(side(old, False)).groupBy(*MAP_KEYS, "cve")
             .agg(F.max("_new").alias("_in_new"), F.min("_new").alias("_only_new")))
    moved = found.filter(F.col("_in_new") == F.col("_only_new"))
    return moved.groupBy(*MAP_KEYS).agg(F.count_if("_in_new").alias("added"),
                                        F.count_if(~F.col("_in_new")).alias("removed"))


def changed_keys(new: DataFrame, old: DataFrame, changed: DataFrame, feeds: list[str] = ()
                 ) -> DataFrame:
    """Keys whose id set differs between two builds, and keys of the new one that hold a changed id.

    Several feeds go through at once: ``feeds`` names the columns that tell them apart. Each side is
    read once, and one shuffle by key and id finds both kinds.
    """
    side = lambda df, is_new: df.select(*feeds, *MAP_KEYS, "cve", F.lit(is_new).alias("_new"))
    # an id of both sides gives two rows for one key, however often it comes
    found = (side(new, True).unionByName(side(old, False)).groupBy(*feeds, *MAP_KEYS, "cve")
             .agg(F.max("_new").alias("_in_new"), F.min("_new").alias("_only_new")))
    ids = changed.select("cve").distinct().withColumn("_changed", F.lit(True))
    marked = found.join(ids, "cve", "left")
    return marked.filter("_in_new = _only_new OR (_in_new AND _changed)").select(*MAP_KEYS).distinct()


def touching(pairs: DataFrame, changed: DataFrame, ident: str = "cve") -> DataFrame:
    """Keys whose set holds one of the changed ids."""
    return pairs.join(changed, ident, "left_semi").select(*MAP_KEYS).distinct()


def metadata_changed(docs: DataFrame, baseline: Column, times: list[str],
                     ident: str = "cve") -> DataFrame:
    """Ids with one of ``times`` after the baseline, as they come.

    They are not de-duplicated: a semi-join does not mind, and AQE can split a hot id only where
    this side is shuffled for the join itself.
    """
    late = F.lit(False)
    for t in times:
        late = late | F.coalesce(F.col(t) > baseline, F.lit(False))
    return docs.filter(late).select(ident)


def change_feed(changed_keys: list[DataFrame], run_ts: str) -> DataFrame:
    """One JSON message per key that any of the frames names.

    A key that changes again in a later run gets a message with another id.
    """
    keys = reduce(DataFrame.unionByName, [k.select(*MAP_KEYS) for k in changed_keys]).distinct()
    ident = text.message_id(F.col("vendor"), F.col("product"), F.lit(run_ts))
    body = F.to_json(F.struct(*MAP_KEYS, F.lit(run_ts).alias("ingestionTimestamp")))
    return keys.select(ident.alias("message_id"),
                       text.message_label(F.col("vendor"), F.col("product")).alias("label"),
                       body.alias("body"))


def batches_of(df: DataFrame, size: int, bucket: Column, order: list[str]) -> DataFrame:
    """Number rows into batches of at most ``size`` within each bucket.

    ``bucket`` spreads the rows and must stay small as the data grows, such as a range of unique
    ids; a global numbering would put all rows into one task, and a popular key its rows.
    """
    spread = df.withColumn("bucket", bucket)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*order))
    return spread.withColumn("batch", F.floor((rank - 1) / size))


def full_batches(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Number all rows into batches of ``size`` in ``order``; only the last one can be smaller.

    Two passes, the rows of each range and the rows of the ranges before; ``order`` must be unique.
    """
    numbered = running_sums(df, [], order, {"_place": F.lit(1).cast("bigint")})
    return numbered.withColumn("batch", F.floor((F.col("_place") - 1) / size)).drop("_place")


def fetch_by_ids(pairs: DataFrame, docs: DataFrame, ident: str = "cve") -> DataFrame:
    """Documents of the ids in a key's set."""
    return pairs.join(docs, ident)


def pair_documents(sets: DataFrame, docs: DataFrame, ident: str = "cve",
                   body: str = "document") -> DataFrame:
    """``[[id, document], ...]`` per key and chunk in id order; missing documents are skipped.

    ``sets`` comes from ``pack_by_bytes``, whose chunks bound what a task collects, or from
    ``pack_id_sets``, which bounds the number of documents. Chunks of a key follow each other.
    """
    keys = [c for c in sets.columns if c != "cves"]
    ids = sets.select(*keys, F.posexplode("cves").alias("_pos", ident))
    item = F.struct("_pos", F.col(ident).alias("_id"), F.col(body).alias("_body"))
    collected = (ids.join(docs.select(ident, body), ident)
                 .groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items")))
    pairs = F.transform("_items", lambda i: F.array(i["_id"].cast("string"), i["_body"]))
    return collected.select(*keys, pairs.alias("pairs"))


def raw_records(nvd: DataFrame, cna: DataFrame, pulled_at: str) -> DataFrame:
    """``pair_documents`` output of both feeds as raw records for ``feeds.stage``.

    Chunks stay separate records; staging unites the chunks of a key.
    """
    side = lambda df, filled, other: df.select(
        F.lit(pulled_at[:10]).alias("ingestionDate"), F.lit(pulled_at).alias("ingestionTimestamp"),
        *MAP_KEYS, (F.size("pairs") > 0).alias("cveDataAvailable"),
        F.col("pairs").alias(filled),
        F.array().cast("array<array<string>>").alias(other))
    return side(cna, "cvelistv5", "fkie_nvd").unionByName(side(nvd, "fkie_nvd", "cvelistv5"))
