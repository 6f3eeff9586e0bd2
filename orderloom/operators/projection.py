"""Principal components on centred vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_pca(vectors: DataFrame, n_components: int = 3) -> tuple[PipelineModel, list[float]]:
    """(model writing ``scores``, explained variance ratio); the largest loading of a component is positive."""
    width = len(vectors.first().features)
    if n_components > width:
        raise ValueError(f"{n_components} components asked of {width} features")
    centre = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="_centred").fit(vectors)
    pca = PCA(k=n_components, inputCol="_centred", outputCol="_raw").fit(centre.transform(vectors))
    loadings = np.array(pca.pc.toArray())
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(n_components)])
    flip = ElementwiseProduct(scalingVec=Vectors.dense(np.where(signs == 0, 1.0, signs)), inputCol="_raw", outputCol="scores")
    return PipelineModel([centre, pca, flip]), [float(x) for x in pca.explainedVariance]


def project(model: PipelineModel, vectors: DataFrame, keep: Sequence[str], n_components: int, prefix: str = "pca") -> DataFrame:
    """``{prefix}_1..`` next to the ``keep`` columns."""
    scores = model.transform(vectors).select(*keep, vector_to_array("scores").alias("_s"))
    return scores.select(*keep, *[F.col("_s")[i].alias(f"{prefix}_{i + 1}") for i in range(n_components)])


def variance_table(vectors: DataFrame, ratio: Sequence[float]) -> DataFrame:
    """(component, explained_ratio, cumulative_ratio)."""
    running = np.cumsum(ratio)
    return vectors.sparkSession.createDataFrame(
        [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratio, running, strict=True))],
        "component int, explained_ratio double, cumulative_ratio double",
    )


def components_for_variance(vectors: DataFrame, targets: Sequence[float] = (0.5, 0.8, 0.9, 0.95)) -> DataFrame:
    """Smallest number of components whose running share reaches each target."""
    _, ratio = fit_pca(vectors, len(vectors.first().features))
    table = variance_table(vectors, ratio)
    reached = table.select("component", F.round("cumulative_ratio", 12).alias("c"))
    row = reached.agg(*[F.min(F.when(F.col("c") >= t, F.col("component"))).alias(f"t{i}") for i, t in enumerate(targets)])
    entries = [F.struct(F.lit(float(t)).alias("target"), F.col(f"t{i}").alias("n_components")) for i, t in enumerate(targets)]
    return row.select(F.inline(F.array(*entries)))
