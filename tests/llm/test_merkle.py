"""The manifest against trees written out in plain Python, and awkward rows."""

import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

import check
from tidewatch.llm import merkle, queries

SF = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def runs(levels, place):
    for nodes in levels[:-1]:
        start = place // 8 * 8
        yield nodes[start:start + 8], place - start
        place //= 8


def plain(rows):
    """Contract rows of (doc_id, source, lang, n_chars, text) rows."""
    lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, encoded(*r), r))
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in groups:
        by[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in by[g]])
    top = tree([trees[g][-1][0] for g in groups])
    for at, g in enumerate(groups):
        for place, (_, _, leaf, r) in enumerate(by[g]):
            path = [*runs(trees[g], place), *runs(top, at)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            folded = encoded(*r[:4], lower(r[4])) if hit else leaf
            for run, k in path:
                folded = h("".join(run[:k] + [folded] + run[k + 1:]))
            proof = h("".join(d for run, k in path for d in run[:k] + run[k + 1:]))
            yield (r[0], leaf, trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0])


def found(spark, rows):
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    return sorted(map(tuple, merkle.digests(docs).collect()), key=str)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    con = check.connect(SF)
    assert check.compare(con, queries.QUERIES["op12_merkle"](spark, SF), queries.ORACLES["op12_merkle"]) == ""


def test_groups_of_all_sizes(spark):
    """One leaf, runs with a single last node, more than a stored level holds, and many groups."""
    sizes = {None: 1, "": 8, "a": 9, "b": 65, "c": 512, "d": 513, "e": 1100, "é": 2, "😀": 1} | {
        f"g{i}": 1 for i in range(60)}
    rows = [(i * 7 + len(lang or ""), f"s{i % 3}", lang, i, f"Text {i} of {lang}")
            for lang, n in sizes.items() for i in range(n)]
    assert found(spark, rows) == sorted(plain(rows), key=str)


def test_awkward_rows(spark):
    rows = [(1, None, "en", None, None), (None, "s", "en", 3, "No id"), (None, "s", "en", 3, "Other"),
            (3, "s", "en", 0, ""), (5, "S", "EN", 9, "Ab" * 40_000), (5, "S", "EN", 9, "Ab" * 40_000),
            (5, "S", "EN", 9, "same id"), (-4, "s", None, 1, "ÄÖÜ é"), (0, "-", "-", 1, "-")]
    assert found(spark, rows) == sorted(plain(rows), key=str)
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string")
    clash = docs.withColumns({c: F.lit("clash") for c in "g place total digest claimed root leaf path".split()})
    assert sorted(map(tuple, merkle.digests(clash).collect()), key=str) == sorted(plain(rows), key=str)
    assert merkle.digests(docs.limit(0)).count() == 0


def test_tampered_leaves_do_not_verify(spark):
    rows = [(i, "s", "en", 1, "Capital" if i % 2 else "none") for i in range(200)]
    for doc_id, *_, verified in found(spark, rows):
        assert verified == (doc_id % 2 == 0 or zlib.crc32(str(doc_id).encode()) % 3 != 0)
