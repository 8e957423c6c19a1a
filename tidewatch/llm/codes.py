"""Vector code compression: product codes by a dual-tree Lloyd iteration in whole numbers.

Components become integers, vectors are cut into equal parts, and every part position has a
codebook of its own. Vectors are kept in blocks. Each block has, for each position, a balanced
tree over its parts: the parts are halved by the component that spreads most until ``LEAF`` are
left, and every node caches the box around its parts and their sum. Blocks are written once and
read in each round.

A round puts a second tree over the entries of the codebook and descends both trees together. For
a pair of nodes the boxes bound the squared distance from below and above; a node of entries whose
lower bound exceeds the least upper bound of another one cannot hold the nearest entry of any part
in the node of parts and is pruned. Among single entries the difference of two distances is bounded
over the box as well, which prunes more. Where a single entry is left the whole node is assigned to it:
its cached sum and count are added and its parts are not looked at. Leaves that stay uncertain
compare their parts with the entries left, in integers. All arithmetic is exact, so the codes are
those of the plain iteration in every run.

Each task returns sums and counts by position and entry, at most parts x entries rows, which Spark
adds up; the driver sees the codebooks alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors of a block and parts of a leaf.
BLOCK = 8192
LEAF = 32


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) with ``v`` the integers floor(scale * x) of the vectors without null and
    non-finite components."""
    vector = F.col("embedding").cast("array<double>")
    whole = F.transform(vector, lambda x: F.floor(x * scale))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x) < float("inf")))
    return rows.where(F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        whole.alias("v"))


def largest(width: int) -> int:
    """Up to this magnitude a long holds the squared distance of two vectors."""
    return isqrt((1 << 62) // max(width, 1)) // 2


def _codable(width: int) -> Column:
    """Vectors as long as the others, of integers that can be squared."""
    most = largest(width)
    return (F.size("v") == width) & (F.size("v") > 0) & F.forall(
        "v", lambda x: x.between(-most, most))


# --- the tree over parts ------------------------------------------------------------------

def depth_of(n: int) -> int:
    """Halvings that leave at most ``LEAF`` of ``n`` parts in a node."""
    depth = 0
    while n > LEAF << depth:
        depth += 1
    return depth


def cuts(n: int, depth: int) -> np.ndarray:
    """Borders of the ``2 ** depth`` nodes of a level over ``n`` parts in tree order."""
    return (np.arange((1 << depth) + 1, dtype=np.int64) * n) >> depth


def plant(points: np.ndarray) -> np.ndarray:
    """The order that puts the parts of every node of the tree next to each other."""
    order = np.arange(len(points))
    for d in range(depth_of(len(points))):
        borders, halves = cuts(len(points), d), cuts(len(points), d + 1)
        for i in range(1 << d):
            a, b, middle = borders[i], borders[i + 1], halves[2 * i + 1]
            here = points[order[a:b]]
            widest = int(np.argmax(here.max(axis=0) - here.min(axis=0)))
            by = np.argpartition(here[:, widest], max(0, min(middle - a, b - a - 1)))
            order[a:b] = order[a:b][by]
    return order


def cached(points: np.ndarray) -> np.ndarray:
    """For ``points`` in tree order: (nodes, 3, width) with the lowest and highest corner of the box
    and the sum of each node, level by level from the root."""
    found = []
    for d in range(depth_of(len(points)) + 1):
        starts = cuts(len(points), d)[:-1]
        found.append(np.stack([np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts),
                               np.add.reduceat(points, starts)], axis=1))
    return np.concatenate(found)


# --- the tree over entries ----------------------------------------------------------------

@dataclass
class EntryTree:
    """Levels of a binary tree over distinct entries; ``boxes[k]`` has the corners of level k, and the
    last level holds single entries, ``index`` their numbers in the codebook."""

    boxes: list[np.ndarray]
    children: list[list[list[int]]]
    index: np.ndarray
    entries: np.ndarray


def entry_tree(book: np.ndarray) -> EntryTree:
    """Of equal entries only the first can be the nearest; the others are left out."""
    seen: dict[bytes, int] = {}
    for i, e in enumerate(book):
        seen.setdefault(e.tobytes(), i)
    groups = [sorted(seen.values())]
    boxes, children = [], []
    while True:
        boxes.append(np.array([[book[g].min(axis=0), book[g].max(axis=0)] for g in groups]))
        if all(len(g) == 1 for g in groups):
            break
        below, links = [], []
        for g in groups:
            if len(g) == 1:
                links.append([len(below)])
                below.append(g)
                continue
            spread = book[g].max(axis=0) - book[g].min(axis=0)
            g = sorted(g, key=lambda i: (book[i][int(np.argmax(spread))], i))
            links.append([len(below), len(below) + 1])
            below += [g[:len(g) // 2], g[len(g) // 2:]]
        children.append(links)
        groups = below
    index = np.array([g[0] for g in groups])
    return EntryTree(boxes, children, index, book[index])


# --- both together ------------------------------------------------------------------------

def _squared(gap: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", gap, gap)


def _bounds(nodes: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of points in two boxes, pair by pair."""
    gap = np.maximum(np.maximum(boxes[:, 0] - nodes[:, 1], nodes[:, 0] - boxes[:, 1]), 0)
    reach = np.maximum(nodes[:, 1] - boxes[:, 0], boxes[:, 1] - nodes[:, 0])
    return _squared(gap), _squared(reach)


def _undominated(nodes: np.ndarray, p: np.ndarray, e: np.ndarray, tree: EntryTree) -> np.ndarray:
    """For pairs of a node of parts and a single entry: whether some part in the box may be nearest.

    The entry nearest to the middle of a box is the rival of the others. The difference of the
    distances to two entries is linear, so its greatest value over the box is at a corner.
    """
    entry = tree.entries[e]
    middle = nodes[:, 0] + nodes[:, 1] - 2 * entry  # twice the way to the middle
    order = np.lexsort([e, _squared(middle), p])
    first = order[np.r_[True, p[order][1:] != p[order][:-1]]]
    rival = np.zeros(int(p.max()) + 1, dtype=np.int64)
    rival[p[first]] = e[first]
    a = tree.entries[rival[p]]
    apart = entry - a
    reach = np.maximum(apart * (nodes[:, 1] - a), apart * (nodes[:, 0] - a)).sum(axis=1)
    most = 2 * reach - _squared(apart)
    # on equal distances the lower number wins
    lost = (most < 0) | ((most == 0) & (tree.index[rival[p]] < tree.index[e]))
    return ~lost | (rival[p] == e)


def descend(n: int, nodes: np.ndarray, tree: EntryTree
            ) -> tuple[list[tuple[int, int, int, int]], np.ndarray, np.ndarray]:
    """What the bounds decide about ``n`` parts, and what they leave open.

    First (first, last, entry, node) for each node that has a single entry left, with its borders in
    tree order; then the pairs (leaf, entry) of the leaves that have several, as two arrays. Entries
    are places in the last level of ``tree``.
    """
    depth, last = depth_of(n), len(tree.boxes) - 1
    done, offset, at = [], 0, 0
    p, e = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for d in range(depth + 1):
        while True:
            least, most = _bounds(nodes[offset + p], tree.boxes[at][e])
            best = np.full(1 << d, np.iinfo(np.int64).max)
            np.minimum.at(best, p, most)
            left = least <= best[p]
            p, e = p[left], e[left]
            if at == last or (d < depth and at >= d):
                break
            # one step down the entries for each step down the parts, and all steps at a leaf
            links = tree.children[at]
            p = np.repeat(p, [len(links[x]) for x in e])
            e = np.array([c for x in e for c in links[x]], dtype=np.int64)
            at += 1
        if at == last:
            kept = _undominated(nodes[offset + p], p, e, tree)
            p, e = p[kept], e[kept]
            borders = cuts(n, d)
            alone = np.bincount(p, minlength=1 << d)[p] == 1
            done += zip(borders[p[alone]], borders[p[alone] + 1], e[alone], offset + p[alone])
            p, e = p[~alone], e[~alone]
        if d < depth:
            offset += 1 << d
            p, e = np.concatenate([2 * p, 2 * p + 1]), np.concatenate([e, e])
        if not len(p):
            break
    return done, p, e


def compare(points: np.ndarray, tree: EntryTree, leaves: np.ndarray, entries: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the parts of open leaves: their places, numbers of the nearest entries and distances.

    Each part is compared with the entries that its leaf has left; ties go to the lower number.
    """
    borders = cuts(len(points), depth_of(len(points)))
    sizes = np.diff(borders)
    far = np.full((len(points), int(tree.index.max()) + 1), np.iinfo(np.int64).max)
    for entry in np.unique(entries):
        here = np.zeros(len(sizes), dtype=bool)
        here[leaves[entries == entry]] = True
        at = np.flatnonzero(np.repeat(here, sizes))
        far[at, tree.index[entry]] = _squared(points[at] - tree.entries[entry])
    open_ = np.zeros(len(sizes), dtype=bool)
    open_[leaves] = True
    places = np.flatnonzero(np.repeat(open_, sizes))
    number = far[places].argmin(axis=1)
    return places, number, far[places, number]


def sums(points: np.ndarray, nodes: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(entries, 1 + width): count and sum of the parts that each entry is nearest to."""
    tree = entry_tree(book)
    total = np.zeros((len(book), 1 + points.shape[1]), dtype=np.int64)
    done, leaves, entries = descend(len(points), nodes, tree)
    for a, b, entry, node in done:
        total[tree.index[entry], 0] += b - a
        total[tree.index[entry], 1:] += nodes[node, 2]
    places, number, _ = compare(points, tree, leaves, entries)
    for entry in np.unique(number):
        here = points[places[number == entry]]
        total[entry, 0] += len(here)
        total[entry, 1:] += here.sum(axis=0)
    return total


def assign(points: np.ndarray, nodes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry and squared distance of every part, in tree order."""
    tree = entry_tree(book)
    code, far = np.zeros(len(points), dtype=np.int64), np.zeros(len(points), dtype=np.int64)
    done, leaves, entries = descend(len(points), nodes, tree)
    for a, b, entry, _ in done:
        gap = points[a:b] - tree.entries[entry]
        code[a:b], far[a:b] = tree.index[entry], _squared(gap)
    places, number, least = compare(points, tree, leaves, entries)
    code[places], far[places] = number, least
    return code, far


# --- on Spark -----------------------------------------------------------------------------

def blocks(codable: DataFrame, width: int, parts: int = PARTS) -> DataFrame:
    """(ids, labels, orders, points, nodes): blocks of vectors with a tree for each position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy().astype(np.int64)
            whole = flat.reshape(batch.num_rows, parts, width // parts)
            for start in range(0, batch.num_rows, BLOCK):
                some = whole[start:start + BLOCK]
                orders = [plant(some[:, k]) for k in range(parts)]
                points = [some[o, k] for k, o in enumerate(orders)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("vec_id").slice(start, len(some)).to_pylist()],
                             pa.list_(pa.int64())),
                    pa.array([batch.column("label").slice(start, len(some)).to_pylist()],
                             pa.list_(pa.int32())),
                    pa.array([np.stack(orders).astype("<i4").tobytes()], pa.binary()),
                    pa.array([np.stack(points).astype("<i4").tobytes()], pa.binary()),
                    pa.array([np.stack([cached(x) for x in points]).astype("<i8").tobytes()],
                             pa.binary())], ["ids", "labels", "orders", "points", "nodes"])

    return codable.mapInArrow(run, "ids array<long>, labels array<int>, orders binary, "
                                   "points binary, nodes binary")


def _read_block(batch: pa.RecordBatch, row: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(batch.column("ids")[row])
    points = np.frombuffer(batch.column("points")[row].as_buffer(), dtype="<i4")
    points = points.reshape(parts, n, -1).astype(np.int64)
    nodes = np.frombuffer(batch.column("nodes")[row].as_buffer(), dtype="<i8")
    return points, nodes.reshape(parts, -1, 3, points.shape[2])


def step(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; ``books`` is (parts, entries, width of a part)."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, 1 + width), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                points, nodes = _read_block(batch, row, parts)
                for k in range(parts):
                    total[k] += sums(points[k], nodes[k], books[k])
        at = np.flatnonzero(total[:, :, 0].ravel())
        rows = total.reshape(parts * entries, 1 + width)[at]
        place = np.repeat(at, 1 + width) * (1 + width) + np.tile(np.arange(1 + width), len(at))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(rows.ravel())],
                                         ["place", "amount"])

    # as many rows as the codebooks have numbers, and as many again for the counts
    read = stored.select("ids", "points", "nodes")
    added = (read.mapInArrow(run, "place long, amount long").groupBy("place")
             .agg(F.sum("amount").alias("amount")).collect())
    total = np.zeros(parts * entries * (1 + width), dtype=np.int64)
    for r in added:
        total[r["place"]] = r["amount"]
    total = total.reshape(parts, entries, 1 + width)
    used = total[:, :, 0] > 0
    moved = books.copy()
    moved[used] = total[used][:, 1:] // total[used][:, :1]  # rounds down, below zero too
    return moved


def encode(stored: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of all vectors in the blocks."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                points, nodes = _read_block(batch, row, parts)
                orders = np.frombuffer(batch.column("orders")[row].as_buffer(), dtype="<i4")
                orders = orders.reshape(parts, -1)
                code = np.zeros((points.shape[1], parts), dtype=np.uint8)
                error = np.zeros(points.shape[1], dtype=np.int64)
                for k in range(parts):
                    found, far = assign(points[k], nodes[k], books[k])
                    code[orders[k], k] = found
                    error[orders[k]] += far
                text = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    batch.column("ids")[row].values, batch.column("labels")[row].values,
                    pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)],
                             pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return stored.select("ids", "labels", "orders", "points", "nodes").mapInArrow(
        run, "vec_id long, label int, code string, error long")


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every sound vector, and the codebooks.

    ``rows`` has vec_id, embedding and label. The first codebooks are the parts of the vectors with
    the smallest ``entries`` vec_ids. Defined cases: vectors that are null or hold null or non-finite
    components are left out; those of another length than the one with the smallest vec_id, and
    those with integers beyond ``largest``, are returned with a null code and error and change no
    codebook; rows that share a vec_id are vectors of their own, in order of their integers; rows
    without one are coded but never come first; fewer vectors than ``entries`` make smaller codebooks; an
    empty table gives no rows; other columns are ignored. ``entries`` is 256 at most. A first vector
    that cannot be cut into ``parts`` is an error.
    """
    sound = cut_lineage(quantised(rows, scale), "quantised")
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = sound.where(F.size("v") > 0).orderBy(*order).limit(1).collect()
    width = len(first[0]["v"]) if first else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} parts")
    codable = sound.where(_codable(width))
    # ``entries`` rows at most
    start = [r["v"] for r in codable.orderBy(*order).limit(entries).collect()]
    books = np.array(start, dtype=np.int64).reshape(len(start), parts, width // parts if width else 0)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    others = sound.where(~_codable(width)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"),
        F.lit(None).cast("long").alias("error"))
    if not start:
        return others, books
    stored = cut_lineage(blocks(codable, width, parts), "blocks")
    for _ in range(rounds):
        books = step(stored, books)
    return encode(stored, books).union(others), books


def codebooks_digest(books: np.ndarray) -> str:
    """Lowercase hex SHA-256 of all components by position, entry and place, joined by commas."""
    return sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def digests(rows: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that ``compress`` returns.

    ``label_error`` adds up the errors of the rows with the same label, those without a label
    together (null where none of them has a code).
    """
    coded, books = compress(rows)
    coded = cut_lineage(coded, "codes")  # read twice
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.withColumnRenamed("label", "__label")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
