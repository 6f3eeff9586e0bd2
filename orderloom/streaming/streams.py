"""Streaming forms of the daily aggregation, metrics, quality, de-duplication and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from orderloom.functions.casts import money_sum
from orderloom.operators import quality


def read_parquet_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def read_order_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.xml") -> DataFrame:
    """Order documents as they arrive in a folder."""
    return (
        spark.readStream.format("xml").schema(schema).option("rowTag", "order").option("pathGlobFilter", pattern).load(folder)
    )


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Zone-less times become UTC timestamps, which watermarks require."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def daily_sales(stream: DataFrame, keys: Sequence[str], ts: str, amount: str, delay: str = "1 day") -> DataFrame:
    """Sum and count per closed day; rows later than ``delay`` are dropped."""
    days = event_time(stream, ts, delay).groupBy(F.window(ts, "1 day"), *keys)
    out = days.agg(money_sum(F.col(amount)).alias("sales"), F.count(F.lit(1)).alias("order_count"))
    return out.select(F.to_date("window.start").alias("date"), *keys, "sales", "order_count")


def event_metrics(
    stream: DataFrame, keys: Sequence[str], ts: str, value: str, size: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Count, rate per second and p50 / p95 / p99 per window and key."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = event_time(stream, ts, delay).groupBy(window, *keys)
    out = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("_p"),
    )
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return out.select(
        F.col("window.start").alias("window_start"),
        *keys,
        "n",
        (F.col("n") / seconds).alias("rate"),
        F.col("_p")[0].alias("p50"),
        F.col("_p")[1].alias("p95"),
        F.col("_p")[2].alias("p99"),
    )


def drop_repeats(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Keep the first row of a key within the watermark delay."""
    return event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def score(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """A fitted model on a stream."""
    return model.transform(stream)


def quality_sink(profile: DataFrame, expected: Sequence[str], path: str, by: Sequence[str] = (), date: str = "date"):
    """``foreachBatch`` function writing the quality report of each micro-batch.

    Each batch overwrites its own folder, so a repeated batch leaves one report.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        report = quality.quality_report(batch, profile, expected, by, date)
        report.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_to_parquet(stream: DataFrame, folder: str, name: str) -> DataFrame:
    """Drain the available input into ``folder/name`` and return the result as a batch table."""
    out, state = f"{folder}/{name}/rows", f"{folder}/{name}/state"
    query: StreamingQuery = (
        stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def run_batches(stream: DataFrame, folder: str, name: str, write) -> None:
    """Drain the available input through a ``foreachBatch`` function."""
    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/{name}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
