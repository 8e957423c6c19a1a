"""Merkle manifest of a dataset: checkpoint-and-recompute trees over groups of rows.

Each group (a language, a partition) has a tree over its leaves in order of their keys; the roots
of the groups are the leaves of one more tree, whose root stands for the whole dataset. While a
level has several nodes, every ``FANOUT`` consecutive ones become the hash of their digests; the
last run may be shorter.

Only every ``STEP``-th level is stored. The levels between two stored ones fall into aligned
subtrees of at most ``FANOUT ** STEP`` stored nodes. To build the next stored level a subtree is
folded in memory; to extract proofs it is folded again, the siblings of every stored node are read
off its regenerated interior nodes, and these are forgotten. A proof thus goes down from stored
level to stored level, and what a task holds is one subtree, however many rows a group has.

Places are numbered without a window over a group: rows are range-partitioned by (group, key),
written in order, and numbered by their place in the partition plus the rows of the group in the
partitions before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

FANOUT = 8
STEP = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the encoded values, one after another."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def join_digests(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels(nodes: list[str], total: int) -> list[list[str]]:
    """``nodes`` of one subtree and the levels above them up to the next stored one.

    ``total`` counts the nodes of the whole group at this level: a single one is its root and is
    not hashed again.
    """
    found = [nodes]
    for _ in range(STEP):
        if total <= 1:
            break
        below = found[-1]
        found.append([join_digests(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
        total = -(-total // FANOUT)
    return found


def siblings(subtree: list[list[str]], place: int) -> list[list[str]]:
    """For each level of a subtree below its top, the other digests of the run of ``place``."""
    found = []
    for nodes in subtree[:-1]:
        start = place - place % FANOUT
        run = nodes[start:start + FANOUT]
        found.append(run[:place - start] + run[place - start + 1:])
        place //= FANOUT
    return found


def fold(digest: str, place: int, path: list[list[str]]) -> str:
    """The root that ``digest`` leads to, at ``place`` of its level, with the siblings ``path``."""
    for run in path:
        at = place % FANOUT
        digest = join_digests(run[:at] + [digest] + run[at:])
        place //= FANOUT
    return digest


def numbered(rows: DataFrame, group: str, key: list[str]) -> DataFrame:
    """``rows`` with ``place``, their number within ``group`` by ``key`` from 0, and the ``total`` of
    the group; nulls come first.

    Rows of equal group and key must be equal altogether, or their order is not fixed.
    """
    order = [F.col(group).asc_nulls_first(), *[F.col(k).asc_nulls_first() for k in key]]
    at = F.monotonically_increasing_id()
    ordered = cut_lineage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.shiftright(at, 33).alias("__part"), at.alias("__at")), "ordered")
    # one row per partition and group that meet: hardly more than there are partitions and groups
    met = ordered.groupBy(group, "__part").agg(F.min("__at").alias("__first"),
                                               F.count("*").alias("__n"))
    before = (Window.partitionBy(group).orderBy("__part")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = cut_lineage(met.select(
        F.col(group).alias("__group"), F.col("__part").alias("__p"), "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy(group)).alias("total")), "starts")
    same = (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__group"))
    return ordered.join(starts, same).select(
        *rows.columns, "total",
        (F.col("__before") + F.col("__at") - F.col("__first")).alias("place"))


def _subtrees(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """(g, total, tree, items): the stored nodes of each aligned subtree in order."""
    width = FANOUT ** STEP
    return (nodes.groupBy("g", "total", F.floor(F.col("place") / width).cast("long").alias("tree"))
            .agg(F.array_sort(F.collect_list(F.struct("place", "digest", *carried)))
                 .alias("items")))


def _parents(nodes: DataFrame) -> DataFrame:
    """The next stored level: one node per subtree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, tops = [], []
            for items, total in zip(batch.column("digests"), batch.column("total").to_pylist()):
                subtree = levels(items.as_py(), total)
                made.append(subtree[-1][0])
                for _ in subtree[1:]:
                    total = -(-total // FANOUT)
                tops.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("g"), pa.array(tops, pa.int64()), batch.column("tree"),
                 pa.array(made, pa.string())], ["g", "total", "place", "digest"])

    trees = _subtrees(nodes, []).select("g", "total", "tree",
                                        F.col("items.digest").alias("digests"))
    return trees.mapInArrow(run, "g string, total long, place long, digest string")


@dataclass
class Tree:
    """Stored levels of the trees of all groups, each (g, total, place, digest, ...), leaves first."""

    stored: list[DataFrame]

    def roots(self) -> DataFrame:
        """(g, root) of each group."""
        return self.stored[-1].select("g", F.col("digest").alias("root"))


def build(leaves: DataFrame) -> Tree:
    """Trees over ``leaves`` (g, total, place, digest, ...), ``numbered`` by ``g``."""
    stored = [cut_lineage(leaves, "level")]
    while (stored[-1].agg(F.max("total")).first()[0] or 0) > 1:
        stored.append(cut_lineage(_parents(stored[-1]), "level"))
    return Tree(stored)


def _path_text(path: list[list[str]]) -> str:
    return "/".join(",".join(run) for run in path)


def _path(text: str) -> list[list[str]]:
    return [[d for d in run.split(",") if d] for run in text.split("/")] if text else []


def proofs(tree: Tree, carried: dict[str, str]) -> DataFrame:
    """(g, place, digest, path, *carried) of every leaf; ``carried`` gives its further columns' types.

    ``path`` has the siblings level by level, a level's in order and joined by commas, levels joined
    by slashes; it is empty for the single leaf of a group. It is extracted from the highest stored
    level downwards.
    """
    above = tree.stored[-1].select("g", "place", F.lit("").alias("path"))
    for i in range(len(tree.stored) - 2, -1, -1):
        more = carried if i == 0 else {}
        above = _descend(tree.stored[i], above, more)
        if i:
            above = cut_lineage(above.select("g", "place", "path"), "paths")
    if len(tree.stored) == 1:
        return tree.stored[0].select("g", "place", "digest", F.lit("").alias("path"), *carried)
    return above


def _descend(nodes: DataFrame, above: DataFrame, carried: dict[str, str]) -> DataFrame:
    """Paths of a stored level from those of the stored level above."""
    names = list(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                items = batch.column("items")[row].as_py()
                top = batch.column("path")[row].as_py()
                g, total = batch.column("g")[row].as_py(), batch.column("total")[row].as_py()
                subtree = levels([x["digest"] for x in items], total)
                rest = "/" + top if top else ""
                paths = [_path_text(siblings(subtree, k)) + rest for k in range(len(items))]
                yield pa.RecordBatch.from_pylist(
                    [{"g": g, "place": x["place"], "digest": x["digest"], "path": p,
                      **{c: x[c] for c in names}} for x, p in zip(items, paths)], schema=schema)

    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = {"g": "string", "place": "long", "digest": "string", "path": "string", **carried}
    schema = pa.schema([(c, kinds[t]) for c, t in columns.items()])
    trees = _subtrees(nodes, names)
    same = (F.col("tree") == F.col("__place")) & F.col("g").eqNullSafe(F.col("__g"))
    joined = trees.join(above.select(F.col("g").alias("__g"), F.col("place").alias("__place"),
                                     "path"), same).select("g", "total", "items", "path")
    return joined.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in columns.items()))


def manifest(rows: DataFrame, key: list[str], carried: dict[str, str]) -> DataFrame:
    """(g, place, digest, path, subroot, top_place, top_path, root, *carried) of every row.

    ``rows`` has a group ``g`` (text or null), a ``digest`` and the columns that ``carried`` names
    with their types; a group's leaves ascend by ``key``, then by digest, nulls first. Groups ascend
    by name, null first, and the tree over their roots gives ``root``. Repeated rows are leaves of
    their own; an empty table gives no rows.
    """
    leaves = rows.select(F.col("g").cast("string").alias("g"), "digest", *carried)
    below = build(numbered(cut_lineage(leaves, "leaves"), "g", [*key, "digest", *[
        c for c in carried if c not in key]]))
    # the same for the groups, as leaves of one tree
    tops = (below.roots().select(F.lit("").alias("g"), F.col("root").alias("digest"),
                                 F.col("g").alias("name")))
    above = build(numbered(tops, "g", ["name"]))
    # written, so that Spark knows how small it is
    named = cut_lineage(proofs(above, {"name": "string"}).select(
        F.col("name").alias("__g"), F.col("digest").alias("subroot"),
        F.col("place").alias("top_place"), F.col("path").alias("top_path")), "groups")
    top = above.roots().select("root")
    joined = proofs(below, carried).join(named, F.col("g").eqNullSafe(F.col("__g"))).drop("__g")
    return joined.withColumn("root", top.scalar())


def verify(proven: DataFrame, claimed: str) -> DataFrame:
    """``proven`` with proof_sha256, folded_root and verified.

    ``folded_root`` is computed from the digest in column ``claimed`` and the siblings of the row;
    ``verified`` says that it is the root. ``proof_sha256`` is the hash of all siblings from the
    leaf's run to the last one below the root.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proof, folded = [], []
            for digest, place, path, top_place, top_path in zip(*[
                    batch.column(c) for c in (claimed, "place", "path", "top_place", "top_path")]):
                low, high = _path(path.as_py()), _path(top_path.as_py())
                proof.append(join_digests([d for run in low + high for d in run]))
                subroot = fold(digest.as_py(), place.as_py(), low)
                folded.append(fold(subroot, top_place.as_py(), high))
            left = batch.drop_columns(["path", "top_path"])
            yield pa.RecordBatch.from_arrays(
                [*left.columns, pa.array(proof, pa.string()), pa.array(folded, pa.string())],
                [*left.schema.names, "proof_sha256", "folded_root"])

    columns = [f for f in proven.schema.fields if f.name not in ("path", "top_path")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    checked = proven.mapInArrow(run, f"{kinds}, proof_sha256 string, folded_root string")
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    The leaf of a row hashes doc_id, source, lang, n_chars and text; groups are languages. Rows
    whose crc32 of the id divides by 3 are checked with a text in lower case, so those with a
    capital A-Z fail. Defined cases: nulls have a mark of their own in the hash; rows without an id
    come first in their group and are not tampered with; repeated rows, also of one id with
    different texts, are leaves of their own in order of their hash; empty texts are texts; other
    columns are ignored.
    """
    fixed = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    whole = leaf(*fixed, text)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("g"),
        whole.alias("digest"),
        F.when(hit, leaf(*fixed, F.translate(text, _UPPER, _LOWER))).otherwise(whole)
        .alias("claimed"))
    proven = manifest(rows, ["doc_id"], {"doc_id": "long", "claimed": "string"})
    return verify(proven, "claimed").select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        "verified")
