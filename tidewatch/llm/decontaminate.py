"""Benchmark decontamination: q-gram counts in diagonal bands, then banded alignment.

A benchmark item of m bytes leaks into a text if some part of the text is within k edits of the
whole item, k a fixed share of m. An item too short for an edit leaks if a text holds it between
word borders. Texts and items are compared in lower case (A-Z) with words joined by single spaces.
The length q of an item's q-grams is 8, or less where k edits could destroy all of them.

1. *Seeds.* Of the disjoint q-grams of an item, k edits destroy k at most. Seeds found in a text
   name an item and a diagonal (place in the text less place in the item), and the surviving
   seeds of a leak lie on diagonals at most k apart. Diagonals are counted in overlapping
   bands of width 2k; a band needs as many distinct seeds as must survive.
2. *Lemma.* In a band that passes, all overlapping q-grams of the item that the region shares
   with it on diagonals near enough are counted; a leak shares m + 1 - q - k q of them.
3. *Alignment.* What remains is aligned to the item within the band of its diagonals; the
   region counts if the edit distance is k or less.

Every step keeps each region that the next one could accept, so the result is that of aligning
all texts with all items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

Q = 8
#: Edits allowed for each byte of an item.
EDIT_SHARE = 0.1
#: Empty items are left out.
MIN_BYTES = 1
#: Items of fewer bytes leak only without edits and between word borders.
EDITED_BYTES = 10
#: Bytes of benchmark text that one pass over the documents holds; a larger set takes more passes.
BLOCK_BYTES = 8 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 20


def normalise(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def grams(data: bytes, q: int = Q) -> np.ndarray:
    """Every run of ``q`` bytes, 8 at most, as a number."""
    if len(data) < q:
        return np.empty(0, dtype="<u8")
    runs = np.ndarray(shape=(len(data) - q + 1,), dtype="<u8", buffer=data + bytes(8 - q),
                      strides=(1,))
    return runs if q == 8 else runs & np.uint64((1 << 8 * q) - 1)


def edits(item: bytes, share: float = EDIT_SHARE) -> int:
    """The edit budget, less than the whole item."""
    return 0 if len(item) < EDITED_BYTES else min(int(len(item) * share), len(item) - 1)


def gram_length(item: bytes, k: int) -> int:
    """The greatest q up to ``Q`` for which ``k`` edits leave a q-gram, and a disjoint one."""
    return min(Q, len(item) // (k + 1))


def bounded(item: bytes) -> re.Pattern:
    """Finds ``item`` where neither end is within a word."""
    letter = rb"[0-9a-z\x80-\xff]"
    return re.compile((rb"(?<!%s)" % letter if re.match(letter, item) else b"")
                      + re.escape(item)
                      + (rb"(?!%s)" % letter if re.match(letter, item[-1:]) else b""))


def banded_distance(item: bytes, text: bytes, start: int, k: int) -> tuple[int, int, int]:
    """(edits, from, to) of the best alignment of ``item`` to a part of ``text`` whose diagonals
    are within ``k`` of ``start``; edits is above ``k`` if none is that good."""
    a, b = np.frombuffer(item, dtype=np.uint8), np.frombuffer(text, dtype=np.uint8)
    m, width = len(a), 2 * k + 1
    far = m + len(b) + 1
    # cell d of row i is the alignment of a[:i] that ends at b[:i + start - k + d]
    ends = start - k + np.arange(width)
    inside = (ends >= 0) & (ends <= len(b))
    row, begin = np.where(inside, 0, far), ends.copy()
    steps = np.arange(width)
    for i in range(1, m + 1):
        ends = ends + 1
        inside = (ends >= 0) & (ends <= len(b))
        use = (ends >= 1) & (ends <= len(b))
        same = np.zeros(width, dtype=bool)
        same[use] = b[ends[use] - 1] == a[i - 1]
        best = np.where(use, row + ~same, far)
        source = begin.copy()
        up = np.append(row[1:], far) + 1  # a byte of the item that the text lacks
        better = up < best
        best, source = np.where(better, up, best), np.where(better, np.append(begin[1:], 0), source)
        best = np.where(inside, best, far)
        # a byte of the text that the item lacks: costs one for each step to the right
        lead = np.minimum.accumulate(best - steps) + steps
        moved = lead < best
        if moved.any():
            at = np.maximum.accumulate(np.where(best - steps == lead - steps, steps, 0))
            source = source[at]
        row, begin = np.where(inside, np.minimum(best, lead), far), source
        if row.min() > k:
            return far, 0, 0
    d = int(row.argmin())
    return int(row[d]), int(begin[d]), int(ends[d])


@dataclass
class Index:
    """The seeds of those items of a block whose q-grams have ``q`` bytes, sorted by q-gram."""
    q: int
    ids: list[int]
    texts: list[bytes]
    short: np.ndarray
    budgets: np.ndarray
    needed: np.ndarray
    seeds: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    present: np.ndarray


def build_index(items: list[tuple[int, str]], share: float = EDIT_SHARE) -> list[Index]:
    """The disjoint q-grams of ``items``, with the number that a leak leaves intact, for each q."""
    by: dict[int, list[tuple[int, bytes, int]]] = {}
    for item_id, text in items:
        raw = normalise((text or "").encode())
        if len(raw) >= MIN_BYTES:
            k = edits(raw, share)
            by.setdefault(gram_length(raw, k), []).append((item_id, raw, k))
    return [_index(q, found) for q, found in sorted(by.items())]


def _index(q: int, items: list[tuple[int, bytes, int]]) -> Index:
    needed, rows = [], []
    for o, (_, raw, k) in enumerate(items):
        all_grams = grams(raw, q)
        used = range(0, len(all_grams), q)
        rows += [(int(all_grams[p]), o, p) for p in used]
        needed.append(len(used) - k)
    rows.sort()
    keys = np.array([r[0] for r in rows], dtype="<u8")
    seeds, first = np.unique(keys, return_index=True)
    present = np.zeros(1 << FILTER_BITS, dtype=bool)
    present[_slot(seeds)] = True
    return Index(q, [r[0] for r in items], [r[1] for r in items],
                 np.array([len(r[1]) < EDITED_BYTES for r in items], bool),
                 np.array([r[2] for r in items], np.int64), np.array(needed, np.int64), seeds,
                 np.append(first, len(rows)), np.array([r[1] for r in rows], np.int64),
                 np.array([r[2] for r in rows], np.int64), present)


def _slot(x: np.ndarray) -> np.ndarray:
    return (x * MIX) >> np.uint64(64 - FILTER_BITS)


def _bands(index: Index, owner: np.ndarray, place: np.ndarray, diagonal: np.ndarray
           ) -> list[tuple[int, int, int]]:
    """(item, lowest diagonal, highest) of the bands with enough distinct seeds."""
    # items with too few seeds in the whole text have no such band
    keep = np.bincount(owner, minlength=len(index.ids))[owner] >= index.needed[owner]
    owner, place, diagonal = owner[keep], place[keep], diagonal[keep]
    if not len(owner):
        return []
    tile = diagonal // (index.budgets[owner] + 1)
    # a seed counts once in a band, wherever in it; bands are two neighbouring tiles
    owner, tile, place = np.tile(owner, 2), np.concatenate([tile, tile - 1]), np.tile(place, 2)
    order = np.lexsort([place, tile, owner])
    owner, tile, place = owner[order], tile[order], place[order]
    band = np.append(True, (np.diff(owner) != 0) | (np.diff(tile) != 0))
    distinct = band | np.append(True, np.diff(place) != 0)
    starts = np.flatnonzero(band)
    enough = np.add.reduceat(distinct.astype(np.int64), starts) >= index.needed[owner[starts]]
    return [(int(o), int(t * (index.budgets[o] + 1)), int((t + 2) * (index.budgets[o] + 1) - 1))
            for o, t in zip(owner[starts[enough]], tile[starts[enough]])]


def _shared(item: bytes, text: bytes, low: int, high: int, q: int) -> int:
    """Places of the item whose q-gram the text has on a diagonal from ``low`` to ``high``."""
    base = max(0, low)
    part = grams(text[base:high + len(item) + 1], q)
    wanted, inverse = np.unique(grams(item, q), return_inverse=True)
    at = np.searchsorted(wanted, part)
    hit = np.flatnonzero(wanted[np.minimum(at, len(wanted) - 1)] == part)
    order = np.argsort(inverse, kind="stable")
    group = np.searchsorted(inverse[order], np.arange(len(wanted) + 1))
    n = np.diff(group)[at[hit]]
    rows = np.repeat(np.arange(len(hit)), n)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    places = order[group[at[hit]][rows] + nth]
    diagonals = hit[rows] + base - places
    return len(np.unique(places[(diagonals >= low) & (diagonals <= high)]))


def search(indexes: list[Index], text: bytes) -> list[tuple[int, int, int, int]]:
    """(item_id, from, to, edits) of the best region of each item that leaks into ``text``."""
    return [leak for index in indexes for leak in _search(index, text)]


def _search(index: Index, text: bytes) -> list[tuple[int, int, int, int]]:
    part = grams(text, index.q)
    maybe = np.flatnonzero(index.present[_slot(part)])
    if not len(maybe):
        return []
    at = np.searchsorted(index.seeds, part[maybe])
    sure = index.seeds[np.minimum(at, len(index.seeds) - 1)] == part[maybe]
    maybe, at = maybe[sure], at[sure]
    n = index.first[at + 1] - index.first[at]
    rows = np.repeat(np.arange(len(at)), n)
    entry = index.first[at][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    owner, place = index.owner[entry], index.place[entry]
    best: dict[int, tuple[int, int, int]] = {}
    short = index.short[owner]
    for o in np.unique(owner[short]).tolist():
        found = bounded(index.texts[o]).search(text)
        if found:
            best[o] = (0, *found.span())
    rows, owner, place = rows[~short], owner[~short], place[~short]
    for o, low, high in _bands(index, owner, place, maybe[rows] - place):
        item, k = index.texts[o], int(index.budgets[o])
        if o in best and best[o][0] == 0:
            continue
        # the true alignment starts up to k before or after the diagonals of its seeds
        if _shared(item, text, low - k, high + k, index.q) < len(item) + 1 - (k + 1) * index.q:
            continue
        at = text.find(item, max(0, low - k), high + k + len(item) + 1)
        if at >= 0:  # the alignment without edits
            best[o] = (0, at, at + len(item))
            continue
        middle, reach = (low + high) // 2, (high - low) // 2 + k + 1
        found = banded_distance(item, text, middle, reach)
        if found[0] <= k and (o not in best or found < best[o]):
            best[o] = found
    return [(index.ids[o], a, b, e) for o, (e, a, b) in best.items()]


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, start, end, edits): one row for each item that leaks into a row of ``docs``.

    ``start`` and ``end`` count bytes of the normalised text. ``benchmark`` (item_id, text) is
    the query set: it is split by hash into blocks of about ``block_bytes``, and each block is
    searched in all documents. Defined cases: null and empty items and texts match nothing;
    repeated rows give repeated leaks; equal items are all reported; a null doc_id or item_id stays
    null; empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // block_bytes

    def passed(block: int) -> DataFrame:
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(
            build_index([(r.item_id, r.text) for r in rows], share))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            indexes = shared.value
            for batch in batches:
                found = []
                ids = batch.column("doc_id")
                for i, x in enumerate(batch.column("text").cast(pa.large_binary())):
                    text = x.as_py()
                    if text and indexes:
                        found += [(ids[i].as_py(), *leak)
                                  for leak in search(indexes, normalise(text))]
                yield pa.RecordBatch.from_pydict(
                    {c: pa.array([r[j] for r in found], pa.int64())
                     for j, c in enumerate(("doc_id", "item_id", "start", "end", "edits"))})

        return documents(docs).mapInArrow(
            run, "doc_id long, item_id long, start long, end long, edits long")

    result = passed(0)
    for block in range(1, blocks):
        result = result.union(passed(block))
    return result


def keep_clean(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with their columns."""
    tagged = docs.withColumn("__key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    hit = leaks(tagged.select(F.col("__key").alias("doc_id"), "text"), benchmark, share)
    hit = hit.select(F.col("doc_id").alias("__key")).distinct()
    return tagged.join(hit, "__key", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
