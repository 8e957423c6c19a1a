"""Table writers and the serving export."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rollups import ALL_VIEWS, LEVEL_KEYS, MEASURES

#: The folder name that Spark gives a NULL partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Text of an NDJSON shard, beyond which there are more shards than asked for.
SHARD_BYTES = 256 << 20


def compact_json(df: DataFrame, path: str, shards: int, compression: str | None = None,
                 shuffle: bool = True) -> None:
    """Many small files to ``shards`` NDJSON files, columns in schema order.

    There are more files where one would hold more than ``SHARD_BYTES`` of text, as a task writes a
    file, and one task has to read it where it is compressed.
    """
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    size = lines.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    shards = max(shards, -(-size // SHARD_BYTES))
    lines = lines.repartition(shards) if shuffle else lines.coalesce(shards)
    writer = lines.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).text(path)


@contextmanager
def _packed_reads(spark: SparkSession, size: int) -> Iterator[None]:
    """Tasks read whole files, packed together up to ``size`` bytes each."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0",
              "spark.sql.files.minPartitionNum": "1", "spark.sql.files.maxPartitionNum": None}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def compact_files(spark: SparkSession, source: str, path: str, shard_bytes: int,
                  compression: str | None = None) -> None:
    """The lines of many small text files in few files, each made of about ``shard_bytes`` of input.

    Spark's reader packs the files of a task up to that size, longest first, and a task writes one
    file: there is no shuffle, no number of shards to guess, and two shards together always exceed
    ``shard_bytes``. Plain files beyond that size are cut between lines, gzip files are not.
    """
    with _packed_reads(spark, shard_bytes):
        lines = spark.read.option("recursiveFileLookup", "true").text(source)
        writer = lines.write.mode("overwrite")
        (writer.option("compression", compression) if compression else writer).text(path)


def _literal(kind: T.DataType, value: object) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(kind, T.IntegralType) else f"'{value}'"


def publish_partitions(df: DataFrame, name: str, parts: list[str], root: str, run: str,
                       touched: DataFrame) -> None:
    """Replace the ``touched`` partitions of the catalog table ``name`` by those in ``df``.

    The rows go into a folder of their own, ``<root>/run=<run>``; then the catalog's partitions are
    pointed at the new folders, and touched ones without rows are dropped. No file is deleted or
    overwritten: who reads a partition meanwhile reads the old files or the new ones, and a
    run that broke off can be run again. The table is created with the first run.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/run={run}"
    df.write.mode("overwrite").partitionBy(*parts).parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder).select(*parts).distinct().collect()
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY "
                  f"({', '.join(f'`{c}`' for c in parts)}) LOCATION '{root.rstrip('/')}/none'")
    kinds = {c: df.schema[c].dataType for c in parts}
    spec = lambda row: "PARTITION (" + ", ".join(
        f"`{c}` = {_literal(kinds[c], row[c])}" for c in parts) + ")"
    place = lambda row: folder + "".join(
        f"/{c}={NO_VALUE if row[c] is None else row[c]}" for c in parts)
    # calendar periods: a short list of names, no data
    for row in written:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec(row)} LOCATION '{place(row)}'")
        spark.sql(f"ALTER TABLE {name} {spec(row)} SET LOCATION '{place(row)}'")
    held = {tuple(row[c] for c in parts) for row in written}
    for row in touched.select(*parts).distinct().collect():
        if tuple(row[c] for c in parts) not in held:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec(row)}")
    spark.catalog.refreshTable(name)


def append_table(df: DataFrame, name: str, partition_by: list[str]) -> None:
    """Create the table if absent, then append."""
    df.write.format("parquet").partitionBy(*partition_by).mode("append").saveAsTable(name)


def create_table_as(df: DataFrame, name: str) -> None:
    df.write.format("parquet").saveAsTable(name)


def overwrite_table(df: DataFrame, path: str, partition_by: list[str],
                    dynamic: bool = False) -> None:
    """Replace the whole table, or with ``dynamic`` only the partitions that ``df`` holds.

    Rows are brought together by partition first, so that a partition gets few files; AQE splits
    the large ones.
    """
    (df.hint("rebalance", *partition_by).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .partitionBy(*partition_by).parquet(path))


def replace_partitions(df: DataFrame, path: str, parts: list[str], touched: DataFrame) -> None:
    """Overwrite the partitions in ``df`` and drop touched ones that ``df`` no longer holds.

    Partitions are calendar periods (or the one without), so the list of emptied ones is short; they
    are deleted one by one. A reader in between may still see a row that has left its partition.
    """
    overwrite_table(df, path, parts, dynamic=True)
    wanted, held = touched.select(*parts).distinct().alias("t"), df.select(*parts).alias("d")
    same = reduce(Column.__and__, [F.col(f"t.{c}").eqNullSafe(F.col(f"d.{c}")) for c in parts])
    spark = df.sparkSession
    for row in wanted.join(held, same, "left_anti").collect():
        names = [f"{c}={NO_VALUE if row[c] is None else row[c]}" for c in parts]
        folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *names]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_version(df: DataFrame, root: str, version: int) -> None:
    """A new folder per version, so that the version being read is never overwritten."""
    df.write.mode("error").parquet(f"{root}/version={version}")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/version={version}")


def _rollup_spec(view: str) -> dict:
    grain, level = view.split("_")
    time = {"daily": "datePublished", "monthly": "month_date", "ytd": "year_date"}[grain]
    # the daily views carry their time column as a dimension, the others their calendar numbers
    period = {"daily": ["datePublished", "year_published"],
              "monthly": ["year_published", "month_published"],
              "ytd": ["year_published"]}[grain]
    kinds = {"datePublished": "string", "threat_index": "double", "network_threat_index": "double"}
    fields = {c: "string" for c in LEVEL_KEYS[level]}
    fields |= {c: kinds.get(c, "bigint") for c in period + MEASURES}
    return {"time": time, "fields": fields | {"risk_rating": "string"}}


def _serving_specs() -> dict[str, dict]:
    # fixed values: column names of the serving tables
    numbers = {"cvssScore", "impactScore", "exploitabilityScore"}
    lookup = ["datePublished", "vendor", "product", "cveId", "descriptions", "cvssScore",
              "severity", "vectorString", "impactScore", "exploitabilityScore", "source",
              "sourceType", "cvssVersion", "vulnStatus", "cweData", "capecData", "cvssData",
              "dateReserved", "dateUpdated", "datePublic", "lastModified"]
    fields = {c: "double" if c in numbers else "string" for c in lookup}
    specs = {"lookup": {"time": "datePublished", "fields": fields | {"year_published": "bigint"}}}
    specs |= {view: _rollup_spec(view) for view in ALL_VIEWS}
    for level in LEVEL_KEYS:
        daily = specs[f"daily_{level}"]
        specs[f"daily_{level}_running"] = {
            "time": daily["time"],
            "fields": daily["fields"] | {"cumulative_threat_index": "double",
                                         "running_risk_rating": "string"}}
    return specs


SERVING_SPECS = _serving_specs()


def export_serving(df: DataFrame, table: str) -> DataFrame:
    """Flat typed rows of a serving table: ``__time``, its fields and ``rows`` = 1.

    Rows are not rolled up. Daily views grouped by day publish the day as their time.
    """
    spec = SERVING_SPECS[table]
    if spec["time"] not in df.columns and spec["time"] == "datePublished":
        df = df.withColumn("datePublished", F.col("date_published").cast("timestamp"))
    return df.select(F.col(spec["time"]).cast("timestamp").alias("__time"),
                     *[F.col(c).cast(t).alias(c) for c, t in spec["fields"].items()],
                     F.lit(1).cast("bigint").alias("rows"))


def write_serving(df: DataFrame, table: str, path: str, incremental: bool = False) -> None:
    mode = "append" if incremental else "overwrite"
    export_serving(df, table).write.mode(mode).parquet(path)
