"""Helpers shared by the text operators: tables, byte batches and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Bytes of text that a numpy kernel holds at once; one longer text is a batch of its own.
BATCH_BYTES = 4 << 20

#: The bytes that separate words: space and 0x09 to 0x0D.
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

#: The same as a regular expression for Spark's functions.
SEPARATORS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that columns of any other name cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of ``df`` and one more field."""
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def byte_batches(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES
                 ) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) of ``doc_id, text`` batches; a null text is empty, a null id None."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        text = batch.column("text").cast(pa.large_binary())
        if text.null_count:
            text = text.fill_null(b"")
        if not ids:
            continue
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:][:len(ids) + 1]
        data = text.buffers()[2]
        data = (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size
                else np.empty(0, dtype=np.uint8))
        start = 0
        while start < len(ids):
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = max(start + 1, min(end, len(ids)))
            yield (ids[start:end], data[offsets[start]:offsets[end]],
                   offsets[start:end + 1] - offsets[start])
            start = end


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) of an undirected graph with edges (a, b); root is the smallest node.

    Large-star and small-star rounds: each node hooks its greater, then its smaller neighbours
    to the smallest one it knows, until no edge changes. The minimum of a node is aggregated on
    the map side and joined back, so no neighbourhood is collected and a hub is split as a
    skewed join is. Each round is written to the shared folder.
    """
    def star(links: DataFrame, up: bool) -> DataFrame:
        both = links.union(links.select("b", "a")) if up else links
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        hooked = both.join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b"), F.col("a").alias("u"))
        hooked = hooked.where("a > u") if up else hooked
        found = hooked.select("a", "b")
        if not up:
            found = found.union(least.select("a", F.col("m").alias("b")))
        return found.where("a != b").distinct()

    def ordered(links: DataFrame) -> DataFrame:
        return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    links = cut_lineage(ordered(edges.select("a", "b")).where("a != b").distinct(), "edges")
    mark = None
    while True:
        links = cut_lineage(ordered(star(ordered(star(links, True)), False)).distinct(), "edges")
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
