"""Vector codes against the plain iteration, and awkward rows."""

import hashlib
import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from tidewatch.llm import codes, queries

SF = "/root/testdata/sf0.001"


def plain(rows, parts=8, entries=16, rounds=6):
    """Contract rows of (vec_id, embedding, label) rows of one length."""
    sound = [r for r in rows if r[1] is not None and all(
        x is not None and math.isfinite(x) for x in r[1])]
    v = {id(r): [math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in sound}
    sound.sort(key=lambda r: (r[0] is None, r[0] or 0, v[id(r)]))
    p = np.array([v[id(r)] for r in sound]).reshape(len(sound), parts, -1)
    book = p[:entries].transpose(1, 0, 2).copy()

    def nearest():
        far = ((p[:, :, None, :] - book[None]) ** 2).sum(axis=3)
        return far.argmin(axis=2), far.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        code, _ = nearest()
        for k in range(parts):
            for e in range(book.shape[1]):
                mine = p[code[:, k] == e, k]
                if len(mine):
                    book[k, e] = mine.sum(axis=0) // len(mine)
    code, error = nearest()
    digest = hashlib.sha256(",".join(map(str, book.ravel())).encode()).hexdigest()
    by = Counter()
    for r, e in zip(sound, error):
        by[r[2]] += int(e)
    return sorted(((r[0], "".join(f"{x:02x}" for x in c), int(e), by[r[2]], digest)
                   for r, c, e in zip(sound, code, error)), key=str)


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    return sorted(map(tuple, codes.digests(df).collect()), key=str)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    con = check.connect(SF)
    assert check.compare(con, queries.QUERIES["op13_codes"](spark, SF), queries.ORACLES["op13_codes"]) == ""


def test_clusters_with_ties(spark):
    """Points on a coarse grid, so that distances and entries are often equal, and one vector that a
    third of all rows share."""
    pick = np.random.default_rng(5)
    rows = [(i, [float(x) for x in pick.integers(-2, 3, 16) / 2], int(i % 3) if i % 7 else None)
            for i in range(600)]
    rows += [(1000 + i, [0.5] * 16, 1) for i in range(300)]
    assert found(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    good = [(i, [math.sin(i * j + 1) * 3 for j in range(8)], 1) for i in range(9)]
    rows = good + [(2, [0.25] * 8, None), (2, [0.25] * 8, None), (None, [-0.1] * 8, 2)]
    bad = [(20, None, 1), (21, [None] + [1.0] * 7, 1), (22, [float("nan")] * 8, 1),
           (23, [float("inf")] + [0.0] * 7, 1), (24, [float("-inf")] * 8, 1)]
    assert found(spark, rows + bad) == plain(rows)
    odd = [(30, [1.0] * 9, 7), (31, [], 7), (32, [3e38] * 8, 7)]
    got = {r[0]: r for r in found(spark, good + odd)}
    assert all(got[i][1:4] == (None, None, None) for i in (30, 31, 32))
    assert [got[r[0]][1:] for r in good] == [r[1:] for r in sorted(plain(good))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    clash = df.withColumns({c: F.lit("clash") for c in "v code error ids place amount __x".split()})
    assert sorted(map(tuple, codes.digests(clash).collect()), key=str) == plain(rows)
    assert codes.digests(df.limit(0)).count() == 0
    assert codes.digests(df.where("vec_id > 100")).count() == 0
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1.0] * 7, 1)], df.schema))


def test_bounds_prune_and_agree():
    pick = np.random.default_rng(6)
    centres = pick.integers(-100_000, 100_000, (16, 4))
    points = centres[pick.integers(0, 16, 3_000)] + pick.integers(-500, 500, (3_000, 4))
    points = points[codes.plant(points)]
    nodes, book = codes.cached(points), centres.copy()
    book[3] = book[9]  # equal entries
    done, leaves, _ = codes.descend(len(points), nodes, codes.entry_tree(book))
    assert sum(b - a for a, b, *_ in done) > 2_000  # most are assigned as whole nodes
    far = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
    code, least = codes.assign(points, nodes, book)
    assert (code == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
    total = codes.sums(points, nodes, book)
    for e in range(16):
        mine = points[far.argmin(axis=1) == e]
        assert total[e, 0] == len(mine) and (total[e, 1:] == mine.sum(axis=0)).all()
