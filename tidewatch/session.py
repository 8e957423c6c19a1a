"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_root: str | None = None
_jobs: list[list[str]] = []


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session with our defaults; on a cluster ``master`` and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local master may fall back to a temporary folder of this machine.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="tidewatch-")
        root = _local_root
    path = f"{root.rstrip('/')}/{label}-{uuid4().hex}"
    for paths in _jobs:
        paths.append(path)
    return path


@contextmanager
def job_folders(spark: SparkSession) -> Iterator[None]:
    """Delete what ``workspace`` hands out inside, once the job has written its tables."""
    made: list[str] = []
    _jobs.append(made)
    try:
        yield
    finally:
        _jobs[:] = [paths for paths in _jobs if paths is not made]  # nested ones can be equal
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query as it ends, not when the driver collects garbage.

    For jobs of many large steps, none of which is run twice.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cut_lineage(df, label: str = "cut"):
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cache this survives lost executors; downstream plans re-read the files
    instead of recomputing the inputs.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
