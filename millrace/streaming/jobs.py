"""Structured Streaming jobs: parsing, dedup, windows, upserts, change feeds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import cdc
from millrace.session import work_dir
from millrace.sources.files import stream_location
from millrace.sources.snapshots import VersionedTable


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet", max_files: int | None = None) -> DataFrame:
    folder, only = stream_location(spark, path)
    reader = spark.readStream.format(format).schema(schema).options(**only)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(folder)


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; plain ones are read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def drain(stream: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Process all available input to a parquet folder (append mode) and read it back."""
    spark = stream.sparkSession
    path, checkpoint = path or work_dir(spark, f"{label}-out"), checkpoint or work_dir(spark, f"{label}-ckpt")
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


class UpdateLog:
    """Results of an update-mode query: one folder per micro-batch, newest row per key wins.

    A repeated batch overwrites its own folder, so restarts do not duplicate rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def write(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def latest(self, keys: Sequence[str]) -> DataFrame:
        # folders hold no `batch` column; it is read as the partition
        full = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(full).parquet(self.path)
        return cdc.newest_per_key(rows, keys, ["batch"]).drop("batch")

    def last_batch(self) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(full).parquet(self.path)
        top = rows.agg(F.max("batch")).first()[0]
        return rows.where(F.col("batch") == top).drop("batch")


def drain_updates(stream: DataFrame, label: str, mode: str = "update") -> UpdateLog:
    spark = stream.sparkSession
    log = UpdateLog(spark, work_dir(spark, f"{label}-log"), stream.schema)
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", work_dir(spark, f"{label}-ckpt")).foreachBatch(log.write)
    query.trigger(availableNow=True).start().awaitTermination()
    return log


def parse_events(messages: DataFrame, schema: T.StructType | str, required: Sequence[str], epoch: str | None = None) -> DataFrame:
    """JSON ``value`` to columns; rows lacking a required field are dropped, epoch seconds become time."""
    rows = messages.select(F.from_json("value", schema).alias("e")).select("e.*")
    for c in required:
        rows = rows.where(F.col(c).isNotNull())
    return rows if epoch is None else rows.withColumn(epoch, F.timestamp_seconds(epoch))


def window_counts(events: DataFrame, at: str, size: str, by: Sequence[str], slide: str | None = None, aggs: Sequence[Column] = ()) -> DataFrame:
    span = F.window(at, size, slide) if slide else F.window(at, size)
    out = events.groupBy(span.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), *aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in out.columns if c != "w"])


def session_counts(events: DataFrame, at: str, gap: str, by: Sequence[str], aggs: Sequence[Column] = ()) -> DataFrame:
    out = events.groupBy(F.session_window(at, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), *aggs)
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *[c for c in out.columns if c != "w"])


def upsert_stream(stream: DataFrame, table: VersionedTable, label: str, make: Callable[[DataFrame, DataFrame], DataFrame],
                  checkpoint: str | None = None, trigger: dict | None = None) -> None:
    """Merge each micro-batch into a versioned table exactly once.

    The batch id is recorded with the version it produced; a batch repeated after a crash is
    recognised and skipped. Only buckets holding changed keys are rewritten.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.rewrite(batch, make, "stream merge", batch=f"{label}:{batch_id}")

    query = stream.writeStream.option("checkpointLocation", checkpoint or work_dir(stream.sparkSession, f"{label}-ckpt")).foreachBatch(apply)
    query.trigger(**(trigger or {"availableNow": True})).start().awaitTermination()


def publish_changes(table: VersionedTable, path: str, keys: Sequence[str], old: int | None, new: int) -> None:
    """Write the row changes between two versions to a feed folder that streams can follow.

    Buckets whose folder is the same in both versions hold the same rows and are not read.
    """
    changed = table.changed_buckets(old, new)
    after = table.read(new, changed)
    before = table.read(old, changed) if old is not None else after.where("false")
    cdc.change_feed(before, after, keys, new).write.mode("append").parquet(path)
