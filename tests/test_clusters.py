import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from orderloom.operators import clustering, components, density, neighbours, projection, segments
from orderloom.operators.features import FeaturePipeline, cardinality_sweep, reduce_cardinality
from orderloom.operators.segmentation import segment_orders


def arrays(spark, x, labels=None):
    rows = [(i, [float(v) for v in p], int(labels[i]) if labels is not None else 0) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


def blobs(n=150, centres=3, d=4, seed=0):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(10 * c, 0.5, (n // centres, d)) for c in range(centres)])


def pair_distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


@pytest.fixture
def mixed_points():
    """Blobs on a coarse grid (many equal points) with scattered noise."""
    rng = np.random.default_rng(1)
    parts = [rng.normal(0, 0.3, (60, 3)), rng.normal(3, 0.3, (60, 3)), rng.uniform(-3, 6, (30, 3)), np.zeros((30, 3))]
    return np.round(np.vstack(parts), 1)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)


def test_kth_distance_is_exact(spark, mixed_points, small_blocks):
    got = {r.id: r.distance for r in neighbours.kth_neighbour(arrays(spark, mixed_points), "id", "features", 5).collect()}
    want = np.sort(pair_distances(mixed_points), axis=1)[:, 4]
    assert len(got) == len(want) and all(abs(got[i] - want[i]) < 1e-12 for i in got)


def test_neighbour_counts_are_exact(spark, mixed_points, small_blocks):
    got = {r.id: r.n_neighbours for r in neighbours.neighbour_counts(arrays(spark, mixed_points), "id", "features", 0.75).collect()}
    want = (pair_distances(mixed_points) <= 0.75).sum(1)
    assert [got[i] for i in range(len(want))] == list(want)


def plain_dbscan(x, eps, min_samples):
    near = pair_distances(x) <= eps
    core = near.sum(1) >= min_samples
    labels, number = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and labels[i] < 0:
            stack, labels[i] = [i], number
            while stack:
                for v in np.nonzero(near[stack.pop()])[0]:
                    if labels[v] < 0:
                        labels[v] = number
                        if core[v]:
                            stack.append(v)
            number += 1
    return labels, core


def test_dbscan_equals_the_plain_form(spark, mixed_points, small_blocks):
    eps = [0.35, 0.55]
    rows = density.dbscan_many(arrays(spark, mixed_points), "id", "features", eps, 5).collect()
    for e in eps:
        labels, core = plain_dbscan(mixed_points, e, 5)
        got = {r.id: r for r in rows if r.eps == e}
        assert [got[i].cluster for i in range(len(labels))] == list(labels)
        assert [got[i].is_core for i in range(len(labels))] == list(core)


def test_many_radii_from_one_forest(spark, mixed_points, small_blocks):
    x = np.vstack([mixed_points, mixed_points[:7], mixed_points[:7], [[1e4] * mixed_points.shape[1]]])
    eps = [0.2, 0.35, 0.55, 0.9, 3.0, 20.0, 1e5]
    rows = density.dbscan_many(arrays(spark, x), "id", "features", eps, 4).collect()
    assert len(rows) == len(eps) * len(x)
    sweep = {r.eps: r for r in density.eps_sweep(arrays(spark, x), "id", "features", eps, 4).collect()}
    square = pair_distances(x) ** 2
    for e in eps:
        labels, core = plain_dbscan(x, e, 4)
        got = {r.id: r for r in rows if r.eps == e}
        assert [got[i].cluster for i in range(len(labels))] == list(labels), e
        assert [got[i].is_core for i in range(len(labels))] == list(core), e
        kinds, want = sorted(set(labels) - {-1}), []
        for i in np.flatnonzero(labels >= 0):
            own = labels == labels[i]
            a = square[i, own].sum() / max(1, own.sum() - 1)
            b = min((square[i, labels == c].mean() for c in kinds if c != labels[i]), default=np.nan)
            want.append(0.0 if own.sum() == 1 or max(a, b) == 0 else (b - a) / max(a, b))
        assert (sweep[e].n_clusters, sweep[e].n_noise) == (len(kinds), (labels < 0).sum())
        assert (sweep[e].silhouette_squared is None) == (len(kinds) < 2)
        assert len(kinds) < 2 or abs(sweep[e].silhouette_squared - np.mean(want)) < 1e-9


def test_many_radii_with_too_few_rows(spark):
    x = np.zeros((3, 2))
    rows = density.dbscan_many(arrays(spark, x), "id", "features", [0.5, 1.0], 4).collect()
    assert len(rows) == 6 and {(r.cluster, r.is_core) for r in rows} == {(-1, False)}


def test_dbscan_with_noise_only(spark):
    x = np.arange(20).reshape(-1, 1) * 10.0
    rows = density.dbscan(arrays(spark, x), "id", "features", 0.5, 3).collect()
    assert {r.cluster for r in rows} == {-1}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5000, 5000)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 1000 and got[5000] == 5000


def test_exact_silhouette(spark, small_blocks):
    x = np.vstack([blobs(90, 3, 2), [[100.0, 100.0]], blobs(90, 3, 2)[:5]])
    labels = np.r_[np.repeat([0, 1, 2], 30), 3, np.zeros(5)].astype(int)
    got = {r.id: r.silhouette for r in clustering.silhouette_rows(arrays(spark, x, labels), "id", "features", "label").collect()}
    d = pair_distances(x)
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            want = 0.0
        else:
            a = d[i, own].sum() / (own.sum() - 1)
            b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
            want = (b - a) / max(a, b)
        assert abs(got[i] - want) < 1e-9
    single = clustering.silhouette_exact(arrays(spark, x[:20], np.zeros(20)), "id", "features", "label").first()
    assert single.silhouette is None


def test_sweep_finds_the_blobs(spark):
    vectors = arrays(spark, blobs()).select("id", array_to_vector("features").alias("features"))
    table, best = clustering.evaluate_kmeans_range(vectors, 2, 5, n_init=3)
    rows = table.orderBy("k").collect()
    assert best == 3 and [r.k for r in rows if r.is_best] == [3]
    inertia = [r.inertia for r in rows]
    assert inertia == sorted(inertia, reverse=True)
    assert all(-1 <= r.silhouette_squared <= 1 and r.calinski_harabasz > 0 for r in rows)
    for bad in ((1, 3), (4, 3), (2, 1000)):
        with pytest.raises(ValueError):
            clustering.evaluate_kmeans_range(vectors, *bad)


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(100, 4)) @ rng.normal(size=(4, 4)) + 5
    vectors = arrays(spark, x).select("id", array_to_vector("features").alias("features"))
    model, ratio = projection.fit_pca(vectors, 4)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(ratio, values / values.sum())
    scores = projection.project(model, vectors, ["id"], 4).toPandas()[[f"pca_{i}" for i in range(1, 5)]].to_numpy()
    assert np.allclose(scores.mean(0), 0, atol=1e-9) and np.allclose(scores.var(0, ddof=1), values)
    needed = {r.target: r.n_components for r in projection.components_for_variance(vectors).collect()}
    running = np.cumsum(values / values.sum())
    assert needed == {t: int(np.argmax(np.round(running, 12) >= t)) + 1 for t in (0.5, 0.8, 0.9, 0.95)}
    with pytest.raises(ValueError):
        projection.fit_pca(vectors, 5)


def orders(spark):
    rows = [(i, 100.0 + 10 * i, i % 4, 50.0 + i, 60.0 + i, i % 24, i % 7, ["Kurier", "Paczkomat"][i % 2], "Karta") for i in range(40)]
    return spark.createDataFrame(
        rows, "order_id long, order_amount_brutto double, n_items int, avg_item_price double, max_item_price double, "
        "hour_of_day int, day_of_week int, delivery_type string, payment_name string")


def test_feature_pipeline(spark):
    df = orders(spark)
    with pytest.raises(RuntimeError):
        FeaturePipeline().transform(df)
    pipeline = FeaturePipeline().fit(df)
    assert len(pipeline.feature_names) == 4 + 4 + 3
    x = pipeline.transform(df).toPandas().to_numpy()
    assert np.allclose(x.mean(0), 0, atol=1e-9)
    std = x.std(0)
    assert np.allclose(std[:-1], 1) and std[-1] == 0
    new = df.limit(1).withColumns({"delivery_type": F.lit("Nowa")}).drop("max_item_price")
    row = pipeline.transform(new).first()
    mean, sd = pipeline.state["max_item_price"]
    assert abs(row["max_item_price"] + mean / sd) < 1e-9
    mean, sd = pipeline.state["delivery_type_Kurier"]
    assert abs(row["delivery_type_Kurier"] + mean / sd) < 1e-9
    again = FeaturePipeline.from_json(pipeline.to_json())
    assert np.allclose(again.transform(df).toPandas().to_numpy(), x)
    wrong = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)], ["features"])
    with pytest.raises(Exception):
        pipeline.named(wrong).collect()


def test_rare_categories_become_other(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",)] + [(None,)], "v string")
    got = reduce_cardinality(df, "v", 3).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {"a": 5, "Other": 3, None: 1}
    sweep = {r.threshold: r.n_categories for r in cardinality_sweep(df, ["v"], [1, 2, 3, 10]).collect()}
    assert sweep == {1: 3, 2: 3, 3: 2, 10: 1}


def summary(spark, rows):
    return spark.createDataFrame(rows, "cluster_id int, size long, order_amount_brutto double, n_items double")


def test_segment_names(spark):
    rows = [(-1, 5, 9999.0, 50.0), (0, 10, 900.0, 1.0), (1, 10, 100.0, 9.0), (2, 10, 50.0, 2.0), (3, 10, 800.0, 8.0), (4, 10, 300.0, 3.0)]
    got = {r.cluster_id: r for r in segments.label_clusters(summary(spark, rows)).collect()}
    assert {k: v.name for k, v in got.items()} == {
        -1: "Outliers / Noise", 0: "Premium Single-Item", 1: "Budget Multi-Item", 2: "Small Quick Purchases",
        3: "High-Value Multi-Item", 4: "Standard Orders",
    }
    assert got[-1].monetary_rank == -1.0 and got[0].monetary_rank == 1.0 and got[4].description.startswith("Average")
    lone = segments.label_clusters(summary(spark, rows[1:2])).first()
    assert (lone.monetary_rank, lone.basket_size_rank, lone.name) == (0.5, 0.5, "Standard Orders")
    flat = segments.radar(summary(spark, rows[1:2]), ["n_items"]).first()
    assert flat.value == 0.0


def test_segmentation_end_to_end(spark):
    enriched, profiles = segment_orders(orders(spark), k_range=(2, 3), n_init=1, eps=2.0, min_samples=3)
    assert enriched.count() == 40 and profiles.count() in (2, 3)
    assert {"cluster_id", "segment", "dbscan_label", "is_noise", "pca_1", "pca_2", "pca_3"} <= set(enriched.columns)
    assert enriched.where("segment is null").count() == 0
    assert segments.attach_labels(enriched.select("order_id", F.lit(77).alias("cluster_id")), profiles, unknown="Unknown").first().segment == "Unknown"


def test_dense_cells_join_through_rows_that_do_not_stand_for_them(spark):
    near = np.array([[0.05], [0.06], [0.95], [1.95], [1.94], [1.05]])
    apart = np.array([[10.05], [10.06], [10.07], [11.95], [11.94], [11.93]])
    rows = density.dbscan(arrays(spark, np.vstack([near, apart])), "id", "features", 1.0, 3).orderBy("id").collect()
    assert [r.cluster for r in rows] == [0] * 6 + [1] * 3 + [2] * 3


def test_one_hot_of_many_values(spark):
    from orderloom.operators import features

    rows = [(i, f"v{i % 5000:04d}", None if i % 3 else "x") for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, name string, kind string")
    model = features.fit_sparse_one_hot(df, ["name", "kind", "absent"])
    names = features.sparse_names(model)
    assert len(names) == 5001 and names[:2] == ["name_v0000", "name_v0001"] and names[-1] == "kind_x"
    more = df.where("id < 4").unionByName(spark.createDataFrame([(9, "new", "x")], df.schema))
    got = {r.id: r.onehot for r in features.sparse_one_hot(model, more).collect()}
    assert got[0].size == 5001 and list(got[0].indices) == [0, 5000] and list(got[1].indices) == [1] and list(got[9].indices) == [5000]
    long = features.set_places(features.sparse_one_hot(model, more), "onehot").collect()
    assert sorted((r.id, r["at"], r.value) for r in long) == [(0, 0, 1.0), (0, 5000, 1.0), (1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (3, 5000, 1.0), (9, 5000, 1.0)]
