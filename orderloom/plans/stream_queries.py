"""Streams drained over the bundled tables (availableNow), read back as batch results."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from orderloom.operators import quality
from orderloom.plans.inputs import rounded
from orderloom.plans.registry import query
from orderloom.session import shared_folder
from orderloom.sources.tables import read_table
from orderloom.streaming import streams


def _stream(spark, d, table):
    return streams.read_parquet_stream(spark, d, read_table(spark, d, table).schema, f"{table}.parquet")


def _folder(spark):
    return f"{shared_folder(spark)}/streams-{uuid.uuid4().hex}"


@query(
    "stream_daily_sales",
    """WITH w AS (SELECT CAST(ts AS DATE) AS date, event_type, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sales, COUNT(*) AS order_count
      FROM events GROUP BY 1, 2)
    SELECT CAST(date AS VARCHAR) AS date, event_type, sales, order_count FROM w
    WHERE CAST(date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM events)""",
)
def stream_daily_sales(spark, d):
    days = streams.daily_sales(_stream(spark, d, "events"), ["event_type"], "ts", "value")
    return rounded(streams.run_to_parquet(days, _folder(spark), "daily"))


@query(
    "stream_event_metrics",
    """WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS t, event_type, COUNT(*) AS n, quantile_disc(value, 0.5) AS p50,
        quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1, 2)
    SELECT CAST(t AS VARCHAR) AS window_start, event_type, n, round(n / 300.0, 6) AS rate, p50, p95, p99 FROM w
    WHERE t + INTERVAL 5 MINUTE <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def stream_event_metrics(spark, d):
    metrics = streams.event_metrics(_stream(spark, d, "events"), ["event_type"], "ts", "value")
    return rounded(streams.run_to_parquet(metrics, _folder(spark), "metrics"))


@query("stream_sliding_metrics")
def stream_sliding_metrics(spark, d):
    metrics = streams.event_metrics(_stream(spark, d, "events"), ["event_type"], "ts", "value", "1 hour", "30 minutes")
    return rounded(streams.run_to_parquet(metrics, _folder(spark), "sliding"))


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark, d):
    """Every event arrives twice and is kept once."""
    twice = _stream(spark, d, "events").unionByName(_stream(spark, d, "events"))
    kept = streams.drop_repeats(twice, ["event_id"], "ts").select("event_id", "user_id", "event_type", "value")
    return streams.run_to_parquet(kept, _folder(spark), "dedup")


@query(
    "stream_quality",
    """SELECT 'missing_column' AS "check", 'absent' AS column_name, 'error' AS severity, CAST(1 AS DOUBLE) AS value, CAST(0 AS BIGINT) AS batch_id
    UNION ALL SELECT 'n_rows', '', 'stat', COUNT(*), 0 FROM events UNION ALL SELECT 'n_cols', '', 'stat', 3, 0
    UNION ALL SELECT 'null_rate_all', '', 'stat', 0, 0
    UNION ALL SELECT 'duplicate_dates', 'date', 'error', COUNT(*) - COUNT(DISTINCT CAST(ts AS DATE)), 0 FROM events""",
)
def stream_quality(spark, d):
    events = read_table(spark, d, "events").select(F.to_date("ts").alias("date"), "value", F.col("user_id"))
    profile = quality.reference_profile(events, ["value", "user_id"])
    incoming = _stream(spark, d, "events").select(F.to_date("ts").alias("date"), "value", "user_id")
    folder = _folder(spark)
    sink = streams.quality_sink(profile, ["date", "value", "user_id", "absent"], f"{folder}/reports")
    streams.run_batches(incoming, folder, "quality", sink)
    return spark.read.parquet(f"{folder}/reports").select("check", "column_name", "severity", "value", "batch_id")


@query("stream_scoring")
def stream_scoring(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    assembler = VectorAssembler(inputCols=["o_totalprice"], outputCol="features")
    model = KMeans(k=3, seed=42, predictionCol="cluster_id").fit(assembler.transform(orders))
    scored = streams.score(_stream(spark, d, "orders"), PipelineModel([assembler, model])).select("o_orderkey", "cluster_id")
    return streams.run_to_parquet(scored, _folder(spark), "scores")


@query("parquet_reload", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def parquet_reload(spark, d):
    """Saved partitioned by status and read back."""
    from orderloom.sources.tables import save_parquet

    path = save_parquet(
        read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), f"{_folder(spark)}/orders", ["o_orderstatus"]
    )
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")
