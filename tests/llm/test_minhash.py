"""Near-duplicates by sketches: against all pairs, and awkward rows."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import minhash, queries

SF = "/root/testdata/sf0.001"


def plain(rows, words=5, percent=85):
    """(n_shingles, component_id, kept) of (doc_id, text) rows by all pairs."""
    sets = []
    for _, text in rows:
        said = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(said[i:i + words]) for i in range(max(1, len(said) - words + 1)))
                    if said else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)]


def found(spark, rows, **parameters):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(map(tuple, minhash.near_duplicates(docs, **parameters).collect()), key=str)


def edited(pick, words, n):
    changed = list(words)
    for at in pick.sample(range(len(words)), n):
        changed[at] = f"new{pick.random()}"
    return " ".join(changed)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op11_minhash"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows))


def test_groups_of_near_copies(spark, monkeypatch):
    """Copies of one text that hardly resemble each other, a chain of small steps, exact copies; with
    blocks so small that a bucket is cut into many."""
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 10_000)
    pick = random.Random(3)
    base = [f"w{pick.randrange(400)}" for _ in range(300)]
    rows = [(100 + i, edited(pick, base, 4)) for i in range(40)] + [(500, " ".join(base))]
    chain = [f"c{pick.randrange(400)}" for _ in range(300)]
    for i in range(12):
        rows.append((200 + i, " ".join(chain)))
        chain = edited(pick, chain, 3).split()
    rows += [(300 + i, " ".join(base[:150])) for i in range(5)]
    pick.shuffle(rows)
    assert found(spark, rows) == sorted(plain(rows), key=str)
    assert found(spark, rows, percent=95) == sorted(plain(rows, percent=95), key=str)


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\f\r"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"),
            (None, "one two"), (7, "x" * 50_000), (7, "x" * 50_000), (7, "another text of the same id"),
            (None, "no id at all here"), (None, "no id at all here"), (8, " "), (9, "a b c d e"),
            (10, " ".join(f"w{i}" for i in range(30_000))), (11, " ".join(f"w{i}" for i in range(29_000)))]
    got = found(spark, rows)
    assert got == sorted([(d, n, c, True if d is None and c is None else k)
                          for d, n, c, k in plain(rows)], key=str)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    extra = docs.withColumns({c: F.lit("clash") for c in "class rep n hi lo bands sketch s kept".split()})
    stay = minhash.keep_one(extra)
    assert stay.columns == extra.columns
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id and r.doc_id != 7) == [
        1, 2, 3, 4, 6, 8, 9, 10]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    assert minhash.keep_one(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs, percent=50)


def test_sketches():
    pick = np.random.default_rng(4)
    for n in (1, 2, 7, 60, 700, 20_000):
        s = np.unique(pick.integers(0, 1 << 63, n).astype(np.uint64))
        whole = minhash.sketch(s)
        assert (whole != minhash._FULL).all()
        assert (minhash.sketch(s[::-1]) == whole).all()
        # the sketch of a union is the least of the sketches
        a, b = s[: n // 2 + 1], s[n // 3:]
        assert (np.minimum(minhash.sketch(a), minhash.sketch(b)) == whole).all()
    agreed = []
    for _ in range(200):
        s = pick.integers(0, 1 << 63, 200).astype(np.uint64)
        agreed.append(np.mean(minhash.sketch(s[:185]) == minhash.sketch(s[15:])))
    assert abs(np.mean(agreed) - 0.85) < 0.01 and min(agreed) > 0.7
