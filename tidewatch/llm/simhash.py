"""SimHash near-duplicates: segment-popcount embedding, grid join, exact check, components.

A 64-bit fingerprint is cut into 32 segments of two bits and mapped to the bit count of each
segment. The Manhattan distance of two such vectors never exceeds their Hamming distance, so it
is a lower bound: what it rules out need not be compared. The vectors are written in unary
(0, 1 or 3 for a count of 0, 1 or 2), which makes the Manhattan distance the number of
differing bits of two longs.

The range join over the grid of vectors uses that a distance of at most ``max_bits`` touches at
most that many of ``max_bits + 4`` groups of segments: two vectors in range agree wholly in some
four groups. Each fingerprint is filed under every choice of four groups; fingerprints that meet
in a cell are compared by the bound and then exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from ..session import cut_lineage
from .common import components, documents

SEED = 42
AGREEING = 4
#: Cells with more members are first split by bytes of the fingerprint, see ``_links``.
SPLIT_ABOVE = 512


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """Majority bits of the XXH64 of the word shingles of ``text``, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, and separators 0x20, 0x09 to 0x0D
    if not words:
        return 0
    joined, w = b" ".join(words), shingle_words
    if len(words) <= w:
        return xxh64_intdigest(joined, SEED)
    ends = list(accumulate([len(x) + 1 for x in words]))
    starts = [0, *ends]
    hashes = np.array([xxh64_intdigest(joined[a:b - 1], SEED)
                       for a, b in zip(starts, ends[w - 1:])], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            fps = np.fromiter((fingerprint(x.as_py() or b"", shingle_words) for x in text),
                              dtype=np.uint64, count=len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return documents(docs).mapInArrow(run, "doc_id long, fp long")


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each in unary within its two bits."""
    low = F.lit(0x5555555555555555)
    shifted = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(shifted).bitwiseAND(low)
    both = fp.bitwiseAND(shifted).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def cells(max_bits: int) -> list[int]:
    """Bit masks of all choices of ``AGREEING`` out of ``max_bits + AGREEING`` groups of segments."""
    groups = np.array_split(np.arange(32), max_bits + AGREEING)
    masks = [sum(3 << int(2 * s) for s in g) for g in groups]
    chosen = [sum(c) for c in combinations(masks, AGREEING)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def _unary(x: np.ndarray) -> np.ndarray:
    low = np.uint64(0x5555555555555555)
    half = x >> np.uint64(1)
    return ((x | half) & low) | ((x & half & low) << np.uint64(1))


def _forest(points: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that join all members of ``points`` linked directly or through each other."""
    left, unary, edges = points, _unary(points), []
    while len(left):
        queue, left, unary = [left[0]], left[1:], unary[1:]
        while queue and len(left):
            p = queue.pop()
            near = np.bitwise_count(unary ^ _unary(p)) <= max_bits  # the lower bound
            idx = np.flatnonzero(near)
            idx = idx[np.bitwise_count(left[idx] ^ p) <= max_bits]  # and exactly
            if len(idx):
                found = left[idx]
                edges += [(p, x) for x in found]
                queue += list(found)
                rest = np.ones(len(left), dtype=bool)
                rest[idx] = False
                left, unary = left[rest], unary[rest]
    return edges


def _links(points: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """As ``_forest``; a large cell is split by the bytes that near fingerprints must share."""
    if len(points) <= SPLIT_ABOVE or max_bits > 6:
        return _forest(points, max_bits)
    edges = []
    for kept in combinations(range(8), 8 - max_bits):
        mask = np.uint64(sum(0xFF << (8 * b) for b in kept))
        key = points & mask
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for part in np.split(order, cuts):
            if len(part) > 1:
                edges += _forest(points[part], max_bits)
    return edges


def links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links.

    Every pair in range is compared in a cell it shares, but a cell returns a spanning forest of
    its links, never all pairs of a dense group.
    """
    filed = classes.select("fp", embedding(F.col("fp")).alias("e")).select(
        "fp", F.explode(F.array(*[
            F.xxhash64(F.lit(i), F.col("e").bitwiseAND(F.lit(m)))
            for i, m in enumerate(cells(max_bits))])).alias("cell"))
    filed = filed.repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

        def edges(cell, fps):
            starts = np.flatnonzero(np.diff(cell, prepend=cell[:1] - 1 if len(cell) else 0))
            sizes = np.diff(starts, append=len(cell))
            found = []
            pairs = starts[sizes == 2]
            if len(pairs):
                a, b = fps[pairs], fps[pairs + 1]
                near = np.bitwise_count(_unary(a) ^ _unary(b)) <= max_bits
                near &= np.bitwise_count(a ^ b) <= max_bits
                found += list(zip(a[near], b[near]))
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                found += _links(fps[s:s + n], max_bits)
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(pairs[:, 0])),
                 pa.array(np.ascontiguousarray(pairs[:, 1]))], ["a", "b"])

        for batch in batches:
            cell = np.concatenate([cell, batch.column("cell").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
            if len(cell):
                whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
                yield edges(cell[:whole], fps[:whole])
                cell, fps = cell[whole:], fps[whole:]
        if len(cell):
            yield edges(cell, fps)

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return filed.select("cell", "fp").mapInArrow(run, schema).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the smallest
    doc_id reachable over links, the document itself included. Defined cases: a null text is
    empty, a text without words has fingerprint zero and links like any other, repeated rows are
    returned as often as they come, a row without doc_id is linked but never names a component
    (null if no member has an id), and an empty table gives no rows. Other columns are ignored.
    """
    fps = cut_lineage(fingerprints(docs, shingle_words), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(classes.select("fp"), max_bits))
    named = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    members = named.join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(members, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component its smallest doc_id stays.

    Rows that share the doc_id that stays are one document, the first by text. Rows without a
    doc_id are known by their text and come behind all others: they go where a component
    has a row with an id, and else all but one go.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # above any id: a hash of 62 bits
    key = F.coalesce(F.col("doc_id").cast("long"),
                     F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62))
    keyed = docs.withColumn("__key", key)
    kept = (near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"), shingle_words, max_bits)
            .where("doc_id = component_id").select(F.col("doc_id").alias("__key")).distinct())
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    first = Window.partitionBy("__key").orderBy("text", F.to_json(F.struct(*others))
                                                if others else F.lit(0))
    ranked = (keyed.join(kept, "__key", "left_semi")
              .withColumn("__rank", F.row_number().over(first)).where("__rank = 1"))
    return ranked.select([F.col(f"`{c}`") for c in docs.columns])
