"""Exactly-once file ingestion and message draining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_new_files(spark: SparkSession, path: str, schema: StructType | str, file_format: str = "parquet",
                   glob: str | None = None, per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def append_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop. The checkpoint is the watermark of files seen."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(out))


def require_backfill(spark: SparkSession, checkpoint: str) -> None:
    """Incremental runs need the checkpoint of a first full run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise RuntimeError(f"no watermark at {checkpoint}; run the backfill first")


def new_files_since(spark: SparkSession, path: str, schema: StructType | str, out: str, checkpoint: str,
                    first_run: bool = False, **source: str) -> StreamingQuery:
    """Copy files added since the last run; nothing new just leaves the checkpoint as it is."""
    if not first_run:
        require_backfill(spark, checkpoint)
    return append_available(read_new_files(spark, path, schema, **source), out, checkpoint)


def dedupe_messages(stream: DataFrame, ident: str = "message_id", time: str | None = None,
                    delay: str = "7 days") -> DataFrame:
    """Each message id once.

    Without a time column every id ever seen stays in the state. With one, repeats are caught
    within ``delay`` and the state stays bounded.
    """
    if time is None:
        return stream.dropDuplicates([ident])
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([ident])


def late_rows(query: StreamingQuery) -> int:
    """Messages that a finished run left out because they came later than the delay allows."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0))
               for progress in query.recentProgress for op in progress["stateOperators"])


def drain_messages(stream: DataFrame, out: str, checkpoint: str, ident: str = "message_id",
                   time: str | None = None) -> StreamingQuery:
    return append_available(dedupe_messages(stream, ident, time), out, checkpoint)


def drain_keeping_late(stream: DataFrame, out: str, late: str, ids: str, checkpoint: str,
                       ident: str = "message_id", time: str = "at", delay: str = "7 days"
                       ) -> StreamingQuery:
    """Each message once to ``out``; what comes more than ``delay`` behind the newest one to ``late``.

    Ids that were let through are kept in ``ids`` by the day of their message and are compared as far
    back as the delay reaches; older days are not read. Later messages can not be told from repeats
    any more, nor can those without a time, so all of them are kept apart and none is lost. Of
    repeats in one batch the earliest is taken. Each batch is a folder of its own, so one that
    is run again after a crash replaces what it wrote.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    known = T.StructType([T.StructField(ident, kinds[ident]), T.StructField(time, kinds[time]),
                          T.StructField("_batch", T.LongType()), T.StructField("_day", T.DateType())])

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder = lambda root: f"{root}/_batch={number}"
        # a place to read from in the first batch, too
        spark.createDataFrame([], known).write.mode("append").partitionBy("_batch", "_day").parquet(ids)
        before = spark.read.schema(known).parquet(ids).filter(F.col("_batch") < number)
        newest = before.agg(F.max(time)).first()[0]  # one value
        horizon = F.lit(newest).cast(kinds[time]) - F.expr(f"INTERVAL {delay}")
        in_time = F.col(time).isNotNull() & (F.lit(True) if newest is None else F.col(time) >= horizon)
        batch.filter(~in_time).write.mode("overwrite").parquet(folder(late))
        seen = before if newest is None else before.filter(F.col("_day") >= F.to_date(horizon))
        order = Window.partitionBy(ident).orderBy(time, F.to_json(F.struct(*stream.columns)))
        first = (batch.filter(in_time).withColumn("_rank", F.row_number().over(order))
                 .filter("_rank = 1").join(seen.select(ident), ident, "left_anti"))
        first.select(*stream.columns).write.mode("overwrite").parquet(folder(out))
        # and a row without an id that tells how far time has come
        mark = batch.filter(in_time).agg(F.max(time).alias(time)).filter(F.col(time).isNotNull())
        (spark.read.schema(stream.schema).parquet(folder(out)).select(ident, time)
         .unionByName(mark.select(F.lit(None).cast(kinds[ident]).alias(ident), time))
         .withColumn("_day", F.to_date(time))
         .write.mode("overwrite").partitionBy("_day").parquet(folder(ids)))

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
