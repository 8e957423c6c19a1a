"""Removal of repeated strings: sampled suffixes, sorted by hash comparison.

A string of ``LENGTH`` bytes is removed if it also starts earlier (smaller doc_id, or the same
document and an earlier start). All strings are judged, but few are sorted:

1. *Anchors.* Every string has an anchor, the place of the least hash among its ``GRAM``-byte
   substrings. Equal strings have equal anchors at equal places, so suffixes that start at
   the strings of different anchors need not be compared. The strings with one anchor in
   a text form a run. A prefix polynomial hash of the text gives the hash of any substring.
2. *Runs.* Rows of runs meet by anchor. Of equal runs all but the first are removed as a whole. A
   task first does this among its own texts, so a passage of many texts is sent once a task.
3. *Suffix sort.* What remains are anchors with several different runs: places where a
   common passage begins or ends. The suffixes of these runs are sorted by a mergesort whose
   comparison finds the common extension of two suffixes by binary search over their prefix
   hashes. Neighbours with ``LENGTH`` bytes in common are equal strings; their bytes are
   compared, so that a collision of hashes removes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..operators.prefix import running_sums
from ..session import cut_lineage
from .common import byte_batches, documents

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1
#: Bytes behind an anchor, and before it, of which every string has the one or the other.
AHEAD = 66
BEHIND = LENGTH - AHEAD
BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Rows of runs that a task holds before it sends them on.
HELD_ROWS = 1 << 19
#: A null doc_id comes after all others.
NO_ID = (1 << 63) - 1


def _powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, 1 << 64))
        out[size:2 * size] = out[:min(size, n - size)] * step
        size *= 2
    return out


class Hashes:
    """Prefix polynomial hashes of ``data`` modulo 2^64; equal substrings have equal hashes."""

    _up = _down = np.empty(0, dtype=np.uint64)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        if len(Hashes._up) <= n:
            size = 1 << int(n + 1).bit_length()
            Hashes._up = _powers(size, BASE)
            Hashes._down = _powers(size, pow(BASE, -1, 1 << 64))
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Hashes._up[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * Hashes._down[start]

    def all(self, length: int) -> np.ndarray:
        """Hashes of the substrings of ``length`` at every place."""
        n = max(0, len(self.prefix) - length)
        x = (self.prefix[length:] - self.prefix[:n]) * Hashes._down[:n]
        return _mixed(x)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def common_extension(hashes: Hashes, a: np.ndarray, b: np.ndarray, limit: int = LENGTH
                     ) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` have in common, ``limit`` at most."""
    low = np.zeros(len(a), dtype=np.int64)
    step = 1 << (limit.bit_length() - 1)
    while step:
        fits = np.flatnonzero(low + step <= limit)
        x, y = a[fits] + low[fits], b[fits] + low[fits]
        same = hashes.of(x, step) == hashes.of(y, step)
        low[fits[same]] += step
        step //= 2
    return low


def sort_suffixes(data: np.ndarray, hashes: Hashes, starts: np.ndarray, bucket: np.ndarray,
                  limit: int = LENGTH) -> np.ndarray:
    """Order of the suffixes by bucket and then by their first ``limit`` bytes.

    A bottom-up mergesort of all buckets at once: at each level every element finds its rank in
    the run beside its own by binary search.
    """
    order = np.argsort(bucket, kind="stable")
    key = bucket[order]
    first = np.searchsorted(key, key, side="left")
    size = np.searchsorted(key, key, side="right") - first
    width = 1
    while True:
        live = np.flatnonzero(size > width)
        if not len(live):
            return order
        rank = live - first[live]
        run = rank // width
        pair = first[live] + (run // 2) * 2 * width
        right = run % 2 == 1
        end = first[live] + size[live]
        low = np.where(right, pair, np.minimum(pair + width, end))
        high = np.where(right, pair + width, np.minimum(pair + 2 * width, end))
        begin = low.copy()
        own = starts[order[live]]
        while True:
            going = np.flatnonzero(low < high)
            if not len(going):
                break
            middle = (low[going] + high[going]) // 2
            a, b = starts[order[middle]], own[going]
            same = common_extension(hashes, a, b, limit)
            full = same == limit
            at = np.minimum(same, limit - 1)
            less = data[a + at] < data[b + at]
            # an element of the right run comes after its equals, one of the left run before
            before = np.where(full, right[going], less)
            low[going] = np.where(before, middle + 1, low[going])
            high[going] = np.where(before, high[going], middle)
        place = pair + rank % width + (low - begin)
        taken = np.zeros(len(order), dtype=bool)
        taken[place] = True
        if not taken[live].all():  # collisions made the comparison contradict itself
            place[np.argsort(place, kind="stable")] = live
        moved = order.copy()
        moved[place] = order[live]
        order = moved
        width *= 2


def equal_strings(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray,
                  limit: int = LENGTH) -> np.ndarray:
    """Class number of each string of ``limit`` bytes; only strings of one bucket are compared."""
    hashes = Hashes(data)
    order = sort_suffixes(data, hashes, starts, bucket, limit)
    a, b = starts[order[:-1]], starts[order[1:]]
    same = bucket[order[:-1]] == bucket[order[1:]]
    near = np.flatnonzero(same)
    near = near[common_extension(hashes, a[near], b[near], limit) == limit]
    same[:] = False
    for block in np.array_split(near, 1 + len(near) // 50_000):  # the bytes themselves
        x = data[a[block][:, None] + np.arange(limit)]
        same[block] = (x == data[b[block][:, None] + np.arange(limit)]).all(axis=1)
    classes = np.empty(len(starts), dtype=np.int64)
    classes[order] = np.cumsum(np.append(0, ~same)) if len(starts) else 0
    return classes


def runs(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The runs of texts behind each other: text number, first string, count, place of the anchor
    behind the first string, hash of the anchor and of the whole run."""
    n = len(data)
    none = {c: np.empty(0, np.int64) for c in ("text", "start", "count", "anchor_at", "anchor",
                                               "whole")}
    if n < LENGTH:
        return none
    hashes = Hashes(data).all(GRAM)
    # the place in the low bits: the least value is the leftmost of the least hashes
    bits = np.uint64(max(24, n.bit_length()))
    least = ((hashes >> bits) << bits) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[:len(least) - (WINDOW - width)], least[WINDOW - width:])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, dtype=np.int64)
    lengths = np.diff(offsets)
    long = np.flatnonzero(lengths >= LENGTH)
    if not len(long):
        return none
    inside[offsets[long]] += 1
    inside[offsets[long + 1] - LENGTH + 1] -= 1
    valid = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    text = np.searchsorted(offsets, valid, side="right") - 1
    new = np.append(True, (np.diff(anchor[valid]) != 0) | (np.diff(text) != 0))
    first = np.flatnonzero(new)
    start, count = valid[first], np.diff(np.append(first, len(valid)))
    raw = data.tobytes()
    whole = np.array([xxh3_64_intdigest(raw[a:b]) for a, b in
                      zip(start.tolist(), (start + count + LENGTH - 1).tolist())], dtype=np.uint64)
    at = anchor[start]
    whole ^= (at - start).astype(np.uint64) * MIX
    return {"text": text[first], "start": start - offsets[text[first]], "count": count,
            "anchor_at": at - start, "anchor": hashes[at].view(np.int64),
            "whole": whole.view(np.int64)}


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document, united where they touch or overlap."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort([start, doc])
    doc, start, end = doc[order], start[order], end[order]
    new_doc = np.append(True, np.diff(doc) != 0)
    # ends grow within a document only, so a shift by document keeps them apart
    shift = np.cumsum(new_doc) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = new_doc | np.append(True, start[1:] + shift[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - shift[last]


_RUN_FIELDS = ("anchor", "whole", "doc_id", "start", "count", "anchor_at")
_RUN_SCHEMA = ("anchor long, whole long, doc_id long, start int, count int, anchor_at int")


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a task's texts, each text of a run once, and what is thereby known to be removed.

    Rows of the second kind have a null ``whole``; ``count`` is the number of bytes.
    """
    held: list[dict] = []

    def send() -> Iterator[pa.RecordBatch]:
        c = {k: np.concatenate([h[k] for h in held]) for k in _RUN_FIELDS}
        order = np.lexsort([c["start"], c["doc_id"], c["whole"], c["anchor"]])
        c = {k: v[order] for k, v in c.items()}
        same = np.append(False, (np.diff(c["anchor"]) == 0) & (np.diff(c["whole"]) == 0))
        group = np.cumsum(~same) - 1
        head = np.flatnonzero(~same)[group]
        # rows that share a doc_id are one document: a place is not earlier than itself
        later = same & ((c["doc_id"] != c["doc_id"][head]) | (c["start"] != c["start"][head]))
        doc, start, end = merged(c["doc_id"][later], c["start"][later],
                                 (c["start"] + c["count"] + LENGTH - 1)[later])
        yield _batch({k: v[~same] for k, v in c.items()}, np.zeros((~same).sum(), bool))
        yield _batch({"anchor": _mixed(doc.astype(np.uint64)).view(np.int64), "whole": doc * 0,
                      "doc_id": doc, "start": start, "count": end - start, "anchor_at": start * 0},
                     np.ones(len(doc), bool))

    for ids, data, offsets in byte_batches(batches, 1 << 20):
        found = runs(data, offsets)
        keys = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
        found["doc_id"] = keys[found.pop("text")]
        held.append(found)
        if sum(len(h["start"]) for h in held) >= HELD_ROWS:
            yield from send()
            held.clear()
    if held:
        yield from send()


def _batch(c: dict[str, np.ndarray], null: np.ndarray) -> pa.RecordBatch:
    kinds = {"start": pa.int32(), "count": pa.int32(), "anchor_at": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c[k], kinds.get(k, pa.int64()), mask=null if k == "whole" else None)
         for k in _RUN_FIELDS], list(_RUN_FIELDS))


def _by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``key``, cut so that no group is parted."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (rest and rest[-1].column(key)[-1].as_py() != keys[0]):
            whole = rest + [batch.slice(0, cut)] if cut else rest
            yield pa.Table.from_batches(whole).combine_chunks().to_batches()[0]
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def _judge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is removed as a whole, and the first run of each text of anchors with several."""
    for batch in _by_group(batches, "anchor"):
        c = {k: batch.column(k).fill_null(0).to_numpy() for k in _RUN_FIELDS}
        known = batch.column("whole").is_null().to_numpy(zero_copy_only=False)
        doc, start, size = c["doc_id"][known], c["start"][known], c["count"][known]
        r = {k: v[~known] for k, v in c.items()}
        new_anchor = np.append(True, np.diff(r["anchor"]) != 0)[:len(r["anchor"])]
        new_whole = new_anchor | np.append(True, np.diff(r["whole"]) != 0)[:len(new_anchor)]
        if len(new_anchor):
            head = np.flatnonzero(new_whole)[np.cumsum(new_whole) - 1]
            later = ((r["doc_id"] != r["doc_id"][head]) | (r["start"] != r["start"][head]))
            doc = np.concatenate([doc, r["doc_id"][later]])
            start = np.concatenate([start, r["start"][later]])
            size = np.concatenate([size, (r["count"] + LENGTH - 1)[later]])
            anchors = np.cumsum(new_anchor) - 1
            several = np.bincount(anchors, weights=new_whole) > 1
            kept = new_whole & several[anchors]
        else:
            kept = new_whole
        doc, start, end = merged(doc, start.astype(np.int64), start.astype(np.int64) + size)
        out = {"anchor": doc * 0, "whole": doc * 0, "doc_id": doc, "start": start,
               "count": end - start, "anchor_at": start * 0}
        yield _batch(out, np.ones(len(doc), bool))
        yield _batch({k: v[kept] for k, v in r.items()}, np.zeros(int(kept.sum()), bool))


_PART_SCHEMA = "key long, doc_id long, start int, count int, anchor_at int, bytes binary"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of asked runs, in up to two parts: strings with ``AHEAD`` bytes behind the
    anchor, which are filed by these, and strings with more than ``BEHIND`` before it."""
    for batch in batches:
        rows = []
        for doc, text, asked in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").cast(pa.large_binary()),
                                    batch.column("asked").to_pylist()):
            raw = text.as_py() or b""
            for a in asked or ():
                anchor, first, count, at = a["anchor"], a["start"], a["count"], a["anchor_at"]
                place, last = first + at, first + count - 1
                cut = max(first, place - BEHIND)  # the first string of the first part
                for low, high, shared in (
                        (cut, last, raw[place:place + AHEAD]),
                        (first, min(cut - 1, last), raw[max(0, place - BEHIND):place + GRAM])):
                    if low <= high:
                        key = xxh3_64_intdigest(shared, anchor & 0xFFFFFFFFFFFFFFFF)
                        key = (key ^ (low == cut)) - (1 << 63)
                        rows.append((key, doc, low, high - low + 1, place - low,
                                     raw[low:high + LENGTH]))
        yield pa.RecordBatch.from_pydict({
            name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate((
                ("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()),
                ("count", pa.int32()), ("anchor_at", pa.int32()), ("bytes", pa.binary())))})


def _judge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts the suffixes of the parts of each key; all but the first of equal strings go."""
    for batch in _by_group(batches, "key"):
        key = batch.column("key").to_numpy()
        group = np.cumsum(np.append(True, np.diff(key) != 0)) - 1
        some = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(some):
            continue
        group = group[some]
        doc, start, count, at = (batch.column(c).to_numpy()[some].astype(np.int64)
                                 for c in ("doc_id", "start", "count", "anchor_at"))
        texts = batch.column("bytes").take(pa.array(some))
        lengths = count + LENGTH - 1
        data = np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8)
        begin = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(some)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        # equal strings have their anchor at the same place
        classes = equal_strings(data, begin[row] + nth,
                                group[row] * (LENGTH + 1) + (at[row] - nth))
        order = np.lexsort([start[row] + nth, doc[row], classes])
        row, nth, classes = row[order], nth[order], classes[order]
        new = np.append(True, np.diff(classes) != 0)
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        place = start[row] + nth
        later = (doc[row] != doc[row[head]]) | (place != place[head])
        d, a, b = merged(doc[row[later]], place[later], place[later] + LENGTH)
        if len(d):
            yield pa.RecordBatch.from_arrays(
                [pa.array(d), pa.array(a, pa.int32()), pa.array(b - a, pa.int32())],
                ["doc_id", "start", "count"])


def _numbers(texts: DataFrame) -> DataFrame | None:
    """(id, digest, number): an own number for each text of ids that several texts share, in order of
    ids, for all rows; None where no id is shared."""
    named = texts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
                         F.xxhash64("text").alias("digest"))
    shared = named.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    if shared.where("low != high").isEmpty():
        return None
    return running_sums(named.distinct(), [], ["id", "digest"], {"number": F.lit(1).cast("long")})


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans): each row of ``docs`` with the byte intervals to remove, in order.

    Defined cases: a null text is empty; a text of fewer than ``LENGTH`` bytes keeps all; of
    repeated strings the one in the smallest doc_id stays, in a row without doc_id only if
    no other row has it. Rows with one id and one text are one document: what goes in one goes in
    all. Different texts with one id, or without one, are documents of their own, in an order that
    their digests fix. An empty table gives no rows; other columns are ignored.
    """
    texts = documents(docs).withColumn("text", F.coalesce("text", F.lit("")))
    numbers = _numbers(texts)
    if numbers is None:
        return _spans(texts)
    numbers = cut_lineage(numbers, "numbers")
    own = (texts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
                        F.xxhash64("text").alias("digest"), "text")
           .join(numbers, ["id", "digest"]).select(F.col("number").alias("doc_id"), "text"))
    found = _spans(own).withColumnRenamed("doc_id", "number")
    return found.join(numbers.select("number", "id"), "number").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "text", "spans")


def _spans(texts: DataFrame) -> DataFrame:
    """``spans`` where no two texts share an id."""
    found = texts.mapInArrow(_run_rows, _RUN_SCHEMA)
    found = found.repartition("anchor").sortWithinPartitions("anchor", "whole", "doc_id", "start")
    judged = cut_lineage(found.mapInArrow(_judge_runs, _RUN_SCHEMA), "runs")

    keyed = texts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
    asked = (judged.where("whole IS NOT NULL").groupBy("doc_id").agg(F.collect_list(
        F.struct("anchor", "start", "count", "anchor_at")).alias("asked")))
    parts = (keyed.join(asked.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "asked")
             .mapInArrow(_parts, _PART_SCHEMA))
    parts = parts.repartition("key").sortWithinPartitions("key")
    removed = judged.where("whole IS NULL").select("doc_id", "start", "count").union(
        parts.mapInArrow(_judge_parts, "doc_id long, start int, count int"))
    removed = removed.groupBy("doc_id").agg(F.sort_array(F.collect_list(
        F.struct("start", "count"))).alias("spans"))
    return (keyed.join(removed.hint("shuffle_hash"), "doc_id", "left")
            .select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
                    "text", "spans"))


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans, kept_sha256): ``kept`` has the remaining bytes.

    The cases are those of ``spans``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, gone, counts = [], [], [], []
            for text, found in zip(batch.column("text").cast(pa.large_binary()),
                                   batch.column("spans").to_pylist()):
                raw, out, done, n = text.as_py() or b"", [], 0, 0
                for s in found or ():
                    start, end = s["start"], min(s["start"] + s["count"], len(raw))
                    if start > done or (start == done and not n):
                        n += start < end
                    if start > done:
                        out.append(raw[done:start])
                    done = max(done, end)
                out.append(raw[done:])
                kept.append(b"".join(out))
                sizes.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return spans(docs).mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, "
                                       "n_spans long, kept_sha256 string")
