"""Cluster summaries and rank-based segment names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rank limits, the noise id and the segment names with their descriptions.
HIGH = 0.7
LOW = 0.3
NOISE_ID = -1
NOISE_NAME = "Outliers / Noise"
MONETARY = "order_amount_brutto"
BASKET = "n_items"

DESCRIPTIONS = {
    "Premium Single-Item": "High-value orders with few expensive products. "
    "Premium segment — focus on upselling accessories.",
    "High-Value Multi-Item": "Large orders with many items at above-average prices. "
    "Wholesale or gift-buyers — offer bundle discounts.",
    "High Spenders": "Above-average order values. Key revenue drivers — prioritize retention.",
    "Budget Multi-Item": "Many items per order but low total value. "
    "Price-sensitive bulk buyers — promote clearance items.",
    "Small Quick Purchases": "Low-value, single-item orders. Impulse buyers — optimize checkout speed.",
    "Budget Shoppers": "Below-average order values. Price-sensitive segment — target with promotions.",
    "Standard Orders": "Average-value orders representing the mainstream. "
    "Core customer base — maintain with loyalty programs.",
    NOISE_NAME: "Transactions identified as outliers by DBSCAN. Investigate for fraud, errors, or unusual patterns.",
}


def cluster_summary(df: DataFrame, features: Sequence[str], cluster: str = "cluster_id") -> DataFrame:
    """Size and mean of each unscaled feature per cluster, noise included."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), *[F.avg(f).alias(f) for f in features])


def rank_clusters(summary: DataFrame, feature: str, out: str, exclude_noise: bool = True) -> DataFrame:
    """Add the ascending position of a cluster mean scaled to [0, 1]; a lone cluster gets 0.5.

    The summary has one row per cluster, so the window is small.
    """
    if feature not in summary.columns:
        return summary.withColumn(out, F.lit(None).cast("double"))
    noise = (F.col("cluster_id") == NOISE_ID) if exclude_noise else F.lit(False)
    group = Window.partitionBy(noise)
    n = F.count(F.lit(1)).over(group)
    position = F.row_number().over(group.orderBy(feature, "cluster_id")) - 1
    rank = F.when(n == 1, F.lit(0.5)).otherwise(position / F.greatest(n - 1, F.lit(1)))
    return summary.withColumn(out, F.when(~noise, rank))


def segment_name(monetary: Column, basket: Column) -> Column:
    rich, poor = monetary >= HIGH, monetary < LOW
    full, thin = basket >= HIGH, basket < LOW
    by_basket = {
        "rich": F.when(thin, "Premium Single-Item").when(full, "High-Value Multi-Item").otherwise("High Spenders"),
        "poor": F.when(full, "Budget Multi-Item").when(thin, "Small Quick Purchases").otherwise("Budget Shoppers"),
    }
    return F.when(rich, by_basket["rich"]).when(poor, by_basket["poor"]).otherwise("Standard Orders")


def label_clusters(summary: DataFrame, monetary: str = MONETARY, basket: str = BASKET) -> DataFrame:
    """cluster_id, name, description, size, monetary_rank, basket_size_rank."""
    ranked = rank_clusters(rank_clusters(summary, monetary, "_m"), basket, "_b")
    noise = F.col("cluster_id") == NOISE_ID
    m, b = F.coalesce("_m", F.lit(0.5)), F.coalesce("_b", F.lit(0.5))
    named = ranked.select(
        "cluster_id",
        F.when(noise, NOISE_NAME).otherwise(segment_name(m, b)).alias("name"),
        "size",
        F.when(noise, F.lit(-1.0)).otherwise(m).alias("monetary_rank"),
        F.when(noise, F.lit(-1.0)).otherwise(b).alias("basket_size_rank"),
    )
    texts = F.create_map(*[F.lit(x) for pair in DESCRIPTIONS.items() for x in pair])
    return named.withColumn("description", F.element_at(texts, F.col("name")))


def attach_labels(df: DataFrame, labels: DataFrame, cluster: str = "cluster_id", unknown: str | None = None) -> DataFrame:
    """Segment name per row; without a match null, or ``unknown`` where given."""
    names = labels.select(F.col("cluster_id").alias(cluster), F.col("name").alias("segment"))
    joined = df.join(F.broadcast(names), cluster, "left")  # one row per cluster
    return joined.fillna({"segment": unknown}) if unknown else joined


def radar(summary: DataFrame, features: Sequence[str]) -> DataFrame:
    """Min-max position of each cluster mean across clusters, noise left out; no spread gives 0.0."""
    kept = summary.where(F.col("cluster_id") != NOISE_ID)
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features]
    long = kept.select("cluster_id", F.inline(F.array(*entries)))
    group = Window.partitionBy("feature")
    low, high = F.min("v").over(group), F.max("v").over(group)
    scaled = F.when(high > low, (F.col("v") - low) / (high - low)).otherwise(F.lit(0.0))
    return long.select("cluster_id", "feature", scaled.alias("value"))
