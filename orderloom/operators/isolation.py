"""Isolation forest (Liu, Ting and Zhou 2008) with trees grown and rows scored in parallel."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.ranks import exact_quantiles

EULER_GAMMA = 0.5772156649015329
TREES = 100
SAMPLE = 256


def path_normaliser(n: float) -> float:
    """Mean path length of an unsuccessful search in a tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def grow_tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, path); feature -1 marks a leaf with its path length."""
    nodes: list[tuple] = []
    todo = [(np.arange(len(x)), 0, 0)]
    free = 1
    while todo:
        rows, depth, node = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_features = np.nonzero(high > low)[0]
        if depth >= limit or len(rows) <= 1 or len(open_features) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + path_normaliser(len(rows))))
            continue
        feature = int(rng.choice(open_features))
        threshold = float(rng.uniform(low[feature], high[feature]))
        left = x[rows, feature] <= threshold
        nodes.append((node, feature, threshold, free, free + 1, 0.0))
        todo += [(rows[left], depth + 1, free), (rows[~left], depth + 1, free + 1)]
        free += 2
    return nodes


def fit_forest(df: DataFrame, key: Sequence[str], columns: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> pd.DataFrame:
    """The forest as a node table of at most trees * (2 * sample) rows.

    Rows are drawn in hash order: first trees * sample candidates (a distributed
    top-k), then ``sample`` of them per tree.
    """
    columns = list(columns)
    mixed = F.xxhash64(*[F.col(k) for k in key], F.lit(seed))
    candidates = df.select(*columns, mixed.alias("_mix")).na.drop().orderBy("_mix", *columns).limit(trees * sample)
    dealt = candidates.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    order = Window.partitionBy("tree").orderBy(F.xxhash64("_mix", "tree"), "_mix", *columns)
    drawn = dealt.withColumn("_p", F.row_number().over(order)).where(F.col("_p") <= sample)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("_p")[columns].to_numpy(dtype="float64")
        limit = math.ceil(math.log2(max(2, min(sample, len(x)))))
        nodes = grow_tree(x, np.random.default_rng([seed, tree]), limit)
        frame = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
        return frame.assign(tree=tree, rows=len(x))

    schema = "node int, feature int, threshold double, left int, right int, path double, tree int, rows int"
    return drawn.groupBy("tree").applyInPandas(grow, schema).toPandas()


def score_rows(df: DataFrame, forest: pd.DataFrame, columns: Sequence[str], out: str = "score") -> DataFrame:
    """Add the anomaly score 2^(-mean path / c); higher is more anomalous."""
    columns = list(columns)
    width = int(forest["node"].max()) + 1
    trees = sorted(forest["tree"].unique())
    shape = (len(trees), width)
    feature, left, right = (np.full(shape, -1, dtype="int32") for _ in range(3))
    threshold, path = np.zeros(shape), np.zeros(shape)
    for i, tree in enumerate(trees):
        part = forest[forest["tree"] == tree]
        at = part["node"].to_numpy()
        feature[i, at], left[i, at], right[i, at] = part["feature"], part["left"], part["right"]
        threshold[i, at], path[i, at] = part["threshold"], part["path"]
    scale = path_normaliser(float(forest["rows"].iloc[0])) or 1.0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[columns].to_numpy(dtype="float64")
            total = np.zeros(len(x))
            for i in range(len(trees)):
                node = np.zeros(len(x), dtype="int32")
                while True:
                    f = feature[i, node]
                    moving = f >= 0
                    if not moving.any():
                        break
                    value = x[np.arange(len(x)), np.maximum(f, 0)]
                    step = np.where(value <= threshold[i, node], left[i, node], right[i, node])
                    node = np.where(moving, step, node)
                total += path[i, node]
            yield pdf.assign(**{out: np.exp2(-total / len(trees) / scale)})

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + f", `{out}` double"
    return df.mapInPandas(score, schema)


def detect_anomalies(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], contamination: float = 0.05, trees: int = TREES, seed: int = 42
) -> DataFrame:
    """Add ``anomaly_score`` (-1 or 1), ``decision`` (negative for anomalies) and ``is_anomaly``.

    The threshold is the ``contamination`` quantile of the negated scores.
    """
    scored = score_rows(df, fit_forest(df, key, columns, trees, seed=seed), columns, "_score")
    normal = scored.withColumn("_normal", -F.col("_score"))
    offset = exact_quantiles(normal, ["_normal"], {"q": contamination}).select("q").scalar()
    marked = normal.withColumn("decision", F.col("_normal") - offset)
    return marked.withColumns(
        {
            "anomaly_score": F.when(F.col("decision") < 0, -1).otherwise(1),
            "is_anomaly": F.col("decision") < 0,
        }
    ).drop("_score", "_normal")


def detect_series_anomalies(series: DataFrame, keys: Sequence[str], contamination: float = 0.05, positive_only: bool = False, trees: int = TREES) -> DataFrame:
    """Forest on the daily sales, each series in units of its own mean.

    Splits do not depend on the scale, so one series gives what the raw values give.
    """
    rows = series.where("sales > 0") if positive_only else series
    mean = F.avg("sales").over(Window.partitionBy(*keys))
    relative = rows.withColumn("_relative", F.when(mean > 0, F.col("sales") / mean).otherwise(F.lit(0.0)))
    return detect_anomalies(relative, [*keys, "date"], ["_relative"], contamination, trees).drop("_relative")
