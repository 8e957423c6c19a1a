"""MinHash near-dedup: fast similarity sketches, banding, exact checks, components.

The sketch of a set has ``COORDINATES`` coordinates. In round 0, 1, ... every element is hashed
into one coordinate with a value; a coordinate keeps the least (round, value) it is given, so the
first round that reaches it decides. What is left empty after ``COORDINATES`` rounds is filled by
as many more, each of which hashes all elements into a single coordinate: every coordinate is
filled. Small sets take many short rounds, large ones a single round, and two sketches agree in a
coordinate with the Jaccard similarity of their sets, concentrated as if coordinates were
independent.

Equal sets are one class. Bands of ``ROWS`` coordinates file classes into buckets: two sets of
similarity 0.85 share none of the ``COORDINATES // ROWS`` buckets with probability 6e-11. What
shares a bucket is then checked on the full sets, in two passes:

1. Every member of a bucket is checked against the bucket's head, the member that meets most
   others in all buckets. This takes one pair a member and joins most groups of near copies.
2. Members of a bucket that are not in one component yet are compared with each other where they
   meet, on their full sets too. Elements that no other such member has bound what a member can
   share: those that cannot be similar to any other are left out before, and pairs out of bounds
   are passed over. Large buckets are dealt in blocks over many tasks, and links return as forests.

Pairs within one component need no check, so all links between different components are found and
no group is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from ..session import cut_lineage
from .common import components, documents

COORDINATES = 128
ROWS = 4
#: Bytes of the sets of a bucket that make a block; a task holds two blocks at a time.
BLOCK_BYTES = 8 << 20

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_VALUE = np.uint64((1 << 56) - 1)
_SEEDS = (np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words make one, none make none."""
    found = text.lower().split()  # of bytes: A-Z only, and separators 0x20, 0x09 to 0x0D
    if not found:
        return np.empty(0, dtype=np.uint64)
    known = {w: xxh3_64_intdigest(w) for w in set(found)}
    h = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    size = min(words, len(h))
    # the number of words keeps a short text apart from a shingle
    rolled = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        rolled = rolled * _STEP + h[i:len(h) - size + 1 + i]
    return np.unique(_mix(rolled))


def sketch(s: np.ndarray) -> np.ndarray:
    """The coordinates of a set of hashes, all of them filled; ``s`` must not be empty."""
    kept = np.full(COORDINATES, _FULL, dtype=np.uint64)
    shift = np.uint64(64 - (COORDINATES.bit_length() - 1))
    rounds = max(1, -(-6 * COORDINATES // len(s)))  # enough for nearly all sets at once
    for start in range(0, COORDINATES, rounds):
        r = np.arange(start, min(COORDINATES, start + rounds), dtype=np.uint64)
        h = _mix(s[None, :] ^ _SEEDS[r.astype(np.int64), None])
        # a later round never beats an earlier one, so further rounds do no harm
        np.minimum.at(kept, (h >> shift).astype(np.int64).ravel(),
                      ((h & _VALUE) | (r << np.uint64(56))[:, None]).ravel())
        if (kept != _FULL).all():
            return kept
    for i in np.flatnonzero(kept == _FULL):
        least = (_mix(s ^ _SEEDS[COORDINATES + i]) & _VALUE).min()
        kept[i] = least | np.uint64(COORDINATES + i) << np.uint64(56)
    return kept


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of ``ROWS`` coordinates, told apart by the band's number."""
    rows = coordinates.reshape(-1, ROWS)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = _mix(keys * _STEP + rows[:, i])
    return keys


def _rep(doc_id: Column, text: Column) -> Column:
    """Where the text of a row can be found again: its id, or a hash of the text without one."""
    return F.coalesce(doc_id, F.xxhash64(text), F.lit(0).cast("long"))


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, rep, n, hi, lo, bands) of every row: the size and 128-bit digest of its set and a key
    for each band of its sketch (none for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, digests, bands = [], [], []
            for x in batch.column("text"):
                s = shingles(x.as_py() or b"", words)
                n.append(len(s))
                digests.append(xxh3_128_digest(s.tobytes()))
                if len(s):
                    bands.append(band_keys(sketch(s)).view(np.int64))
                else:
                    bands.append(None)
            halves = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rep"), pa.array(n, pa.int64()),
                 pa.array(np.ascontiguousarray(halves[:, 0])),
                 pa.array(np.ascontiguousarray(halves[:, 1])),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "rep", "n", "hi", "lo", "bands"])

    rows = documents(docs).select("doc_id", _rep(F.col("doc_id"), F.col("text")).alias("rep"),
                                  F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, rep long, n long, hi long, lo long, "
                                "bands array<long>")


def classes(sketched: DataFrame) -> DataFrame:
    """One numbered row per distinct non-empty set, with its smallest doc_id as ``first``.

    The numbers hold once the frame is written.
    """
    grouped = (sketched.where("n > 0").groupBy("hi", "lo")
               .agg(F.min("doc_id").alias("first"), F.min("rep").alias("rep"),
                    F.first("n").alias("n"), F.first("bands").alias("bands")))
    return grouped.withColumn("class", F.monotonically_increasing_id())


def candidates(found: DataFrame) -> DataFrame:
    """(bucket, class, size) of all buckets with several classes; ``size`` counts its members."""
    filed = found.select("class", F.explode("bands").alias("bucket"))
    shared = filed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return filed.join(shared, "bucket").select("bucket", "class", "size")


def head_pairs(filed: DataFrame) -> DataFrame:
    """Distinct (a, b): every member of a bucket with the member that meets most others in all."""
    weight = filed.groupBy("class").agg(F.sum("size").alias("weight"))
    weighed = filed.join(weight, "class")
    heads = weighed.groupBy("bucket").agg(
        F.max(F.struct("weight", F.negative("class").alias("class"))).alias("head"))
    return (filed.join(heads, "bucket")
            .select(F.col("class").alias("a"), F.negative("head.class").alias("b"))
            .where("a != b").distinct())


def sets_of(docs: DataFrame, wanted: DataFrame, words: int = 5) -> DataFrame:
    """(class, n, s): the full sets of the classes ``wanted``, made again from the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [shingles(x.as_py() or b"", words).tobytes()
                     for x in batch.column("text")]
            halves = np.frombuffer(b"".join(map(xxh3_128_digest, found)), dtype=">i8")
            halves = halves.reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(halves[:, 0])),
                 pa.array(np.ascontiguousarray(halves[:, 1])), pa.array(found, pa.binary())],
                ["hi", "lo", "s"])

    rows = documents(docs).withColumn("rep", _rep(F.col("doc_id"), F.col("text")))
    texts = rows.join(wanted.select("rep").distinct(), "rep", "left_semi").select(
        F.col("text").cast("binary").alias("text"))
    made = texts.mapInArrow(run, "hi long, lo long, s binary")
    # rows that share an id may bring other texts, or one text twice
    return (made.join(wanted.select("class", "hi", "lo", "n"), ["hi", "lo"])
            .groupBy("class").agg(F.first("n").alias("n"), F.first("s").alias("s")))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = 85) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= ``percent`` * union of their full sets."""
    left = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("s").alias("s_a"))
    right = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("s").alias("s_b"))
    sizes = left.select("a", "n_a"), right.select("b", "n_b")
    possible = pairs.join(sizes[0], "a").join(sizes[1], "b").where(
        f"100 * least(n_a, n_b) >= {int(percent)} * greatest(n_a, n_b)").select("a", "b")
    both = possible.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b")):
                x = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                merged = np.concatenate([x, y])
                merged.sort(kind="stable")  # merges the two sorted runs
                common = int(np.count_nonzero(merged[1:] == merged[:-1]))
                similar.append(100 * common >= percent * (len(merged) - common))
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def shared_sizes(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, n, core) of the classes ``wanted``: the size of the set, and how many of its elements
    some other of these classes has, too. No intersection with one of them exceeds that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, s in zip(batch.column("class").to_pylist(), batch.column("s")):
                element = np.frombuffer(s.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(element), pa.array(np.full(len(element), c))], ["element", "class"])

    held = sets.join(wanted, "class", "left_semi")
    elements = held.select("class", "s").mapInArrow(run, "element long, class long")
    # an element of thousands of classes is brought down to two numbers before the shuffle
    single = (elements.groupBy("element").agg(F.min("class").alias("class"), F.max("class").alias("last"))
              .where("class = last").groupBy("class").agg(F.count("*").alias("own")))
    return held.select("class", "n").join(single, "class", "left").select(
        "class", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("core"))


def _forest(ids: np.ndarray, root: np.ndarray, side: np.ndarray, core: np.ndarray,
            sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members of different roots and sides, as many as join what is linked.

    The sets of all members that could be similar to one are counted at once against a mark at each
    of its elements. What a link joins is one root from then on.
    """
    n = np.array([len(s) for s in sets])
    starts = np.cumsum(n) - n
    names, element = np.unique(np.concatenate(sets), return_inverse=True)
    marked, root, found = np.zeros(len(names), dtype=np.int64), root.copy(), []
    for i in range(len(ids) - 1):
        common = np.minimum(core[i], core[i + 1:])
        other = np.flatnonzero((root[i + 1:] != root[i]) & (side[i + 1:] != side[i])
                               & (100 * common >= percent * (n[i] + n[i + 1:] - common))) + i + 1
        if not len(other):
            continue
        mine = element[starts[i]:starts[i] + n[i]]
        marked[mine] = 1
        sizes = n[other]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts[other] - (ends - sizes), sizes)
        shared = np.add.reduceat(marked[element[at]], ends - sizes)
        marked[mine] = 0
        for j in other[100 * shared >= percent * (n[i] + sizes - shared)]:
            if root[j] != root[i]:
                found.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return found


def apart_links(filed: DataFrame, sets: DataFrame, roots: DataFrame, percent: int = 85) -> DataFrame:
    """(a, b): links of classes that share a bucket but lie in different components of ``roots``.

    Classes whose elements are too much their own to be similar to any other are left out first. The
    full sets of the others are compared where they meet. A bucket of more than ``BLOCK_BYTES`` is
    cut into blocks, and each pair of blocks is a cell of its own, so that no task holds more than
    about two blocks. A cell returns a spanning forest of its links, never all pairs.
    """
    named = filed.join(roots, filed["class"] == roots["node"], "left").select(
        "bucket", "class", F.coalesce("root", "class").alias("root"))

    def mixed(members: DataFrame, size: Column) -> DataFrame:
        several = (members.groupBy("bucket").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.sum(size).alias("size"))
            .where("low < high").select("bucket", "size"))
        return members.join(several, "bucket")

    first = cut_lineage(mixed(named, F.lit(0)).drop("size"), "apart")
    able = shared_sizes(sets, first.select("class").distinct()).where(
        F.col("core") * 100 >= percent * F.col("n"))
    kept = mixed(first.join(able, "class"), 8 * F.col("n"))
    blocks = F.ceil(F.col("size") / BLOCK_BYTES).cast("long")
    at = F.pmod(F.xxhash64("class"), blocks)
    open_ = (kept.withColumn("at", at).withColumn("other", F.explode(F.sequence(
                 F.lit(0).cast("long"), blocks - 1)))
             .select(F.xxhash64("bucket", F.least("at", "other"), F.greatest("at", "other"))
                     .alias("cell"), "class", "root", "core",
                     # a cell of two blocks has the pairs across them; in a cell of one block
                     # each member is a side of its own
                     F.when(F.col("at") == F.col("other"), F.col("class"))
                     .when(F.col("at") < F.col("other"), -1).otherwise(-2).alias("side")))
    dealt = (open_.join(sets.select("class", "s"), "class")
             .repartition("cell").sortWithinPartitions("cell", "class"))

    def links(rows: pa.Table) -> pa.RecordBatch:
        cell, ids, root, core, side = (rows.column(c).to_numpy() for c in (
            "cell", "class", "root", "core", "side"))
        found = rows.column("s").combine_chunks()
        starts = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1))
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(cell))):
            if b - a > 1 and (root[a:b] != root[a]).any():
                out += _forest(ids[a:b], root[a:b], side[a:b], core[a:b],
                               [np.frombuffer(found[int(i)].as_buffer(), dtype=np.uint64)
                                for i in range(a, b)], percent)
        made = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(made[:, 0])),
                                           pa.array(np.ascontiguousarray(made[:, 1]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            if cut or (held and held[-1].column("cell")[-1].as_py() != cell[0]):
                yield links(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield links(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows link where 100 * intersection >= ``percent`` * union of their sets of word shingles;
    ``component_id`` is the smallest doc_id reachable over links, the row itself included, and
    ``kept`` says that it is the row's own. Defined cases: a null text is empty, and a text without
    words has an empty set that links with nothing; repeated rows are returned as often as they
    come; a row without doc_id is linked but names no component (a component without ids has
    component_id null, and its rows are all kept); an empty table gives no rows. Other columns are
    ignored. ``percent`` is 85 or more; below, more bands would be needed.
    """
    if not 85 <= percent <= 100:
        raise ValueError("the bands are laid out for 85 percent or more")
    sketched = cut_lineage(sketches(docs, words), "sketches")
    found = cut_lineage(classes(sketched), "classes")
    filed = cut_lineage(candidates(found), "buckets")
    in_buckets = filed.select("class").distinct()
    wanted = found.select("class", "rep", "hi", "lo", "n").join(in_buckets, "class", "left_semi")
    sets = cut_lineage(sets_of(docs, wanted, words), "sets")
    links = cut_lineage(confirm(head_pairs(filed), sets, percent), "links")
    roots = cut_lineage(components(links), "roots")
    more = cut_lineage(apart_links(filed, sets, roots, percent), "links")
    # what the second pass joins are whole components
    if not more.isEmpty():
        roots = components(links.union(more))
    named = found.join(roots, found["class"] == roots["node"], "left").select(
        "hi", "lo", "first", F.coalesce("root", "class").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    members = named.join(least, "root").select("hi", "lo", "component_id")
    # an empty set has no class
    joined = sketched.join(members, ["hi", "lo"], "left").withColumn(
        "component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                         F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of each group of near-duplicates.

    Rows of groups without any doc_id stay, and so do all rows that share the id that stays.
    """
    kept = near_duplicates(docs, words, percent).where("kept").select("doc_id").distinct()
    here = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["doc_id"]), "left_semi")
    return here.select([F.col(f"`{c}`") for c in docs.columns])
