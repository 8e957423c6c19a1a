"""Compare registered queries with their SQL: ``python tests/check.py [sf_dir] [names...]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import tempfile
import time
from collections import Counter
from glob import glob

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(v).__name__, plain(v)) for v in (r[i] for i in order)) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(con, df, sql):
    """Empty text when both results hold the same rows under the same names and types."""
    found = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = rows_of(df.columns, found), rows_of(names, expected)
    compare.count = len(found)
    if left == right:
        return ""
    return (f"{len(found)} rows against {len(expected)}\n  only Spark: {list((left - right))[:2]}"
            f"\n  only SQL:   {list((right - left))[:2]}\n  columns: {sorted(names)}")


def main(sf_dir="/root/testdata/sf0.01", *only):
    import __spark_entry__ as entry
    from tidewatch.session import build_session
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                  "spark.ui.enabled": "false",
                                                  "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-"),
                                                  "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(con, fn(spark, sf_dir), oracles[name]) if name in oracles else "no sql"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s rows={getattr(compare, 'count', None)} {problem}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
