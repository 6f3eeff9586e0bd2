"""The whole segmentation: features, sweep, clusters, density noise, projection, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import clustering, density, projection, segments
from orderloom.operators.features import FeaturePipeline
from orderloom.session import settle


def segment_orders(
    orders: DataFrame,
    pipeline: FeaturePipeline | None = None,
    key: str = "order_id",
    k_range: tuple[int, int] = (2, 10),
    k: int | None = None,
    n_init: int = 10,
    eps: float = 0.5,
    min_samples: int = 5,
    n_components: int = 3,
    summary_features: Sequence[str] = ("order_amount_brutto", "n_items", "avg_item_price", "max_item_price"),
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(orders with cluster_id, segment, dbscan_label, is_noise, pca_1..; segment profiles).

    ``k`` overrides the choice by silhouette.
    """
    # Every step below reads the orders again, so they are computed once.
    orders = settle(orders)
    pipeline = (pipeline or FeaturePipeline()).fit(orders)
    vectors = settle(pipeline.vectors(orders, [key]))
    if k is None:
        _, model = clustering.sweep_kmeans(vectors, *k_range, n_init, seed)
    else:
        model = clustering.fit_kmeans(vectors, k, n_init, seed)
    labels = model.transform(vectors).select(key, "cluster_id")
    arrays = vectors.select(key, vector_to_array("features").alias("features"))
    dense = density.dbscan(arrays, key, "features", eps, min_samples).select(
        key, F.col("cluster").alias("dbscan_label"), (F.col("cluster") == -1).alias("is_noise")
    )
    n_components = min(n_components, len(pipeline.feature_names))
    pca, _ = projection.fit_pca(vectors, n_components)
    scores = projection.project(pca, vectors, [key], n_components)
    clustered = orders.join(labels, key)
    profiles = segments.label_clusters(segments.cluster_summary(clustered, list(summary_features)))
    enriched = segments.attach_labels(clustered, profiles).join(dense, key).join(scores, key)
    return enriched, profiles
