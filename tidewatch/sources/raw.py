"""Raw feed files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import RAW


def read_raw(spark: SparkSession, path: str | list[str], schema: str = RAW) -> DataFrame:
    """NDJSON with a fixed schema; gzip files are read as they are."""
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
          .withColumn("source_file", F.col("_metadata.file_path")))
    return df.withColumns({
        "ingestionTimestamp": text.pull_timestamp(F.col("ingestionTimestamp")),
        "ingestionDate": F.to_date(F.try_to_timestamp("ingestionDate", F.lit("yyyy-MM-dd"))),
    })


def latest_partition(df: DataFrame, column: str = "ingestionDate") -> DataFrame:
    """Rows of the newest partition; Spark prunes the others by the subquery's value."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def latest_folder(spark: SparkSession, root: str, pattern: str = r"\d{4}-\d{2}-\d{2}") -> str:
    """Path of the newest dated folder directly below ``root``, by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    dated = [e.getPath().getName() for e in entries
             if e.isDirectory() and re.fullmatch(pattern, e.getPath().getName())]
    if not dated:
        raise LookupError(f"no dated folder below {root}")
    return f"{root.rstrip('/')}/{max(dated)}"


def latest_table(spark: SparkSession, prefix: str, database: str = "default") -> str:
    """Newest table named ``<prefix>_yyyy_MM_dd``."""
    dated = (spark.sql(f"SHOW TABLES IN {database}")
             .filter(F.col("tableName").rlike(rf"^{prefix}_\d{{4}}_\d{{2}}_\d{{2}}$"))
             .agg(F.max("tableName").alias("name")).first())
    if dated.name is None:
        raise LookupError(f"no {prefix} table in {database}")
    return dated.name


def file_name_metadata(df: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Vendor, product and pull time out of ``<vendor>_cve_<product>_raw_<time>.json``."""
    stamp = r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}"
    pattern = rf"^(.+)_cve_(.+)_raw_({stamp})\.json$"
    part = lambda i: F.regexp_extract(file_name, pattern, i)
    when = F.try_to_timestamp(part(3), F.lit("yyyy-MM-dd_HH-mm-ss"))
    return df.withColumns({
        "vendor": part(1),
        "product": part(2),
        "ingestionTimestamp": when,
        "ingestionDate": F.to_date(when),
        "incomplete": (part(1) == "") | (part(2) == "") | (part(3) == ""),
    })


def with_file_name(df: DataFrame) -> DataFrame:
    """Add the name of the file a row was read from."""
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Yearly feed files, plain or gzip; unreadable lines come out in ``_corrupt_record``."""
    with_corrupt = f"{schema}, _corrupt_record string"
    return spark.read.schema(with_corrupt).option("mode", "PERMISSIVE").json(path)
