"""Views -> serving tables, in full or as far as files are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import tables
from ..streaming import files


def publish(spark: SparkSession, views: str, out: str, checkpoint: str, first_run: bool = False,
            names: list[str] | None = None) -> None:
    """Export the new files of the serving tables below ``views`` to ``<out>/<table>/batch=<n>``.

    All tables are exported, or those in ``names``. The checkpoint of a table knows the files it has
    exported; the first run takes all of them, a later one needs the first run's checkpoint. A batch
    is a folder of its own and replaces itself when it is run again, so no row comes twice.
    """
    for table in names or tables.SERVING_SPECS:
        seen = f"{checkpoint}/{table}"
        if not first_run:
            files.require_backfill(spark, seen)
        path = f"{views}/{table}"
        stream = files.read_new_files(spark, path, spark.read.parquet(path).schema)

        def write(batch: DataFrame, number: int, table: str = table) -> None:
            tables.export_serving(batch, table).write.mode("overwrite").parquet(
                f"{out}/{table}/batch={number}")

        (stream.writeStream.foreachBatch(write).option("checkpointLocation", seen)
         .trigger(availableNow=True).start().awaitTermination())


def read_serving(spark: SparkSession, out: str, table: str) -> DataFrame:
    """All batches of a serving table."""
    return spark.read.parquet(f"{out}/{table}")
