"""Clustering, density and projection queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderloom.operators import clustering, density, neighbours, projection
from orderloom.operators.features import LOGGED, NUMERIC, FeaturePipeline, reduce_cardinality
from orderloom.operators.segmentation import segment_orders
from orderloom.plans.inputs import orders_grain, rounded
from orderloom.plans.registry import query
from orderloom.session import settle
from orderloom.sources.tables import read_table


def _arrays(spark, d):
    return read_table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("features"), F.col("label").cast("int").alias("label")
    )


def _numeric_pipeline():
    return FeaturePipeline(numerical=list(NUMERIC), logged=list(LOGGED), cyclical={}, categorical=[])


def _order_vectors(spark, d):
    og = settle(orders_grain(spark, d))
    return _numeric_pipeline().fit(og).vectors(og, ["order_id"])


# Distances from the double values, so that both sides see the same numbers.
_PAIRS_SQL = """
v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label AS la, b.label AS lb, list_distance(a.e, b.e) AS dist FROM v a CROSS JOIN v b)
"""


@query(
    "knn_distance",
    "WITH " + _PAIRS_SQL + """, r AS (SELECT a, dist, row_number() OVER (PARTITION BY a ORDER BY dist) AS p FROM pairs)
    SELECT a AS vec_id, round(dist, 6) AS distance FROM r WHERE p = 5""",
)
def knn_distance(spark, d):
    return rounded(neighbours.kth_neighbour(_arrays(spark, d), "vec_id", "features", 5))


@query(
    "k_distance_curve",
    "WITH " + _PAIRS_SQL + """, r AS (SELECT a, dist, row_number() OVER (PARTITION BY a ORDER BY dist) AS p FROM pairs),
    c AS (SELECT a AS vec_id, dist, row_number() OVER (ORDER BY dist DESC) AS position, COUNT(*) OVER () AS n FROM r WHERE p = 5)
    SELECT round(dist, 6) AS distance, position, CAST(position <= floor(n * 0.1) AS INT) AS in_top_tenth FROM c""",
)
def k_distance_curve(spark, d):
    curve = density.k_distance_curve(neighbours.kth_neighbour(_arrays(spark, d), "vec_id", "features", 5), "vec_id")
    # Near-equal distances may swap places between engines, so the key is left out.
    return rounded(curve.drop("vec_id"))


@query(
    "k_distance_percentiles",
    "WITH " + _PAIRS_SQL + """, r AS (SELECT a, dist, row_number() OVER (PARTITION BY a ORDER BY dist) AS p FROM pairs)"""
    + " UNION ALL ".join(f" SELECT {p} AS percent, round(quantile_cont(dist, {p / 100}), 6) AS eps FROM r WHERE p = 5" for p in (50, 75, 90, 95, 99)),
)
def k_distance_percentiles(spark, d):
    return rounded(density.k_distance_percentiles(neighbours.kth_neighbour(_arrays(spark, d), "vec_id", "features", 5)))


EPS = 1.2
# The radii 0.5 to 5.0 in steps of 0.5.
EPS_LIST = [k / 2 for k in range(1, 11)]


@query("eps_pairs", "WITH " + _PAIRS_SQL + f"SELECT a AS vec_id, COUNT(*) AS n_neighbours FROM pairs WHERE dist <= {EPS} GROUP BY 1")
def eps_pairs(spark, d):
    return neighbours.neighbour_counts(_arrays(spark, d), "vec_id", "features", EPS)


def _sizes(spark, d):
    """Orders as points: price in 10,000s, lines, and pieces in 50s."""
    lines = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("l_quantity").cast("double")).alias("q")
    )
    orders = read_table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return orders.select("o_orderkey", F.array(F.col("o_totalprice").cast("double") / 10000.0, "n", F.col("q") / 50.0).alias("features"))


_SIZES_SQL = """WITH l AS (SELECT l_orderkey, COUNT(*)::DOUBLE AS y, SUM(l_quantity::DOUBLE) / 50 AS z FROM lineitem GROUP BY 1),
p AS (SELECT o_orderkey AS k, o_totalprice::DOUBLE / 10000 AS x, y, z FROM orders JOIN l ON o_orderkey = l_orderkey),
d AS (SELECT a.k, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS dist FROM p a JOIN p b ON {}) """


@query("knn_distance_orders", _SIZES_SQL.format("true") + "SELECT k AS o_orderkey, round(min(dist, 5)[-1], 6) AS distance FROM d GROUP BY 1")
def knn_distance_orders(spark, d):
    return rounded(neighbours.kth_neighbour(_sizes(spark, d), "o_orderkey", "features", 5))


@query("eps_pairs_orders", _SIZES_SQL.format("a.y = b.y") + "SELECT k AS o_orderkey, COUNT(*) AS n_neighbours FROM d WHERE dist <= 0.25 GROUP BY 1")
def eps_pairs_orders(spark, d):
    return neighbours.neighbour_counts(_sizes(spark, d), "o_orderkey", "features", 0.25)


def _dbscan_sql(eps: float) -> str:
    return "WITH RECURSIVE " + _PAIRS_SQL + f"""
    , near AS (SELECT a, b FROM pairs WHERE dist <= {eps}),
    core AS (SELECT a FROM near GROUP BY a HAVING COUNT(*) >= 5),
    link AS (SELECT a, b FROM near WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
    walk AS (SELECT a AS node, a AS root FROM core UNION SELECT link.b, walk.root FROM walk JOIN link ON link.a = walk.node),
    comp AS (SELECT node, MIN(root) AS c FROM walk GROUP BY node),
    num AS (SELECT c, CAST(row_number() OVER (ORDER BY c) - 1 AS INT) AS cluster FROM (SELECT DISTINCT c FROM comp)),
    border AS (SELECT n.a AS node, MIN(comp.c) AS c FROM near n JOIN comp ON comp.node = n.b WHERE n.a NOT IN (SELECT a FROM core) GROUP BY 1),
    allc AS (SELECT * FROM comp UNION ALL SELECT * FROM border),
    lab AS (SELECT v.vec_id, COALESCE(num.cluster, -1) AS cluster, CAST(v.vec_id IN (SELECT a FROM core) AS INT) AS is_core
       FROM v LEFT JOIN allc ON allc.node = v.vec_id LEFT JOIN num ON num.c = allc.c)
    """


@query("dbscan", _dbscan_sql(EPS) + "SELECT vec_id, cluster, is_core FROM lab")
def dbscan(spark, d):
    return rounded(density.dbscan(_arrays(spark, d), "vec_id", "features", EPS))


# Least names are handed on step by step; 40 steps are more than any shortest path between these rows.
_SWEEP_SQL = "WITH RECURSIVE " + _PAIRS_SQL + f"""
, near AS MATERIALIZED (SELECT eps, a, b, dist FROM pairs JOIN (SELECT UNNEST({EPS_LIST})::DOUBLE AS eps) r ON dist <= eps),
core AS MATERIALIZED (SELECT eps, a FROM near GROUP BY ALL HAVING COUNT(*) >= 5),
link AS MATERIALIZED (SELECT n.eps, n.a, n.b FROM near n JOIN core c ON c.eps = n.eps AND c.a = n.a JOIN core e ON e.eps = n.eps AND e.a = n.b),
walk AS (SELECT eps, a AS node, a AS root, 0 AS i FROM core
  UNION ALL (SELECT w.eps, l.b, MIN(w.root), w.i + 1 FROM walk w JOIN link l ON l.eps = w.eps AND l.a = w.node WHERE w.i < 40 GROUP BY w.eps, l.b, w.i)),
comp AS (SELECT eps, node, MIN(root) AS c FROM walk GROUP BY ALL),
border AS (SELECT n.eps, n.a AS node, MIN(comp.c) AS c FROM near n JOIN comp ON comp.eps = n.eps AND comp.node = n.b
  WHERE NOT EXISTS (SELECT 1 FROM core WHERE core.eps = n.eps AND core.a = n.a) GROUP BY ALL),
placed AS MATERIALIZED (SELECT * FROM comp UNION ALL SELECT * FROM border),
away AS (SELECT x.eps, x.node, x.c, y.c AS other, SUM(p.dist * p.dist) AS t, COUNT(*) AS n
  FROM pairs p JOIN placed x ON x.node = p.a JOIN placed y ON y.node = p.b AND y.eps = x.eps GROUP BY ALL),
judged AS (SELECT eps, node, c, MAX(CASE WHEN c = other AND n > 1 THEN t / (n - 1) END) AS a, MIN(CASE WHEN c <> other THEN t / n END) AS b FROM away GROUP BY ALL),
scored AS (SELECT eps, CASE WHEN COUNT(DISTINCT c) > 1 THEN AVG(COALESCE((b - a) / greatest(a, b), 0)) END AS s FROM judged GROUP BY eps),
counted AS (SELECT eps, COUNT(*) AS k, COUNT(DISTINCT c) AS clusters FROM placed GROUP BY eps)
SELECT r.eps, COALESCE(clusters, 0) AS n_clusters, (SELECT COUNT(*) FROM v) - COALESCE(k, 0) AS n_noise,
  round(100.0 * ((SELECT COUNT(*) FROM v) - COALESCE(k, 0)) / (SELECT COUNT(*) FROM v), 6) AS noise_pct, round(s, 6) AS silhouette_squared
FROM (SELECT UNNEST({EPS_LIST})::DOUBLE AS eps) r LEFT JOIN counted USING (eps) LEFT JOIN scored USING (eps)
"""


@query("eps_sweep", _SWEEP_SQL)
def eps_sweep(spark, d):
    return rounded(density.eps_sweep(_arrays(spark, d), "vec_id", "features", EPS_LIST))


@query(
    "silhouette_squared_rows",
    "WITH " + _PAIRS_SQL + """
    , m AS (SELECT a, la, lb, SUM(dist * dist) AS t, COUNT(*) AS n FROM pairs GROUP BY 1, 2, 3),
    s AS (SELECT a, la, MAX(CASE WHEN la = lb AND n > 1 THEN t / (n - 1) END) AS x, MIN(CASE WHEN la <> lb THEN t / n END) AS y FROM m GROUP BY 1, 2)
    SELECT a AS vec_id, CAST(la AS INT) AS cluster, round(COALESCE((y - x) / greatest(x, y), 0), 6) AS silhouette FROM s""",
)
def silhouette_squared_rows(spark, d):
    return rounded(clustering.silhouette_squared_rows(_arrays(spark, d), "vec_id", "features", "label"))


@query("dbscan_orders")
def dbscan_orders(spark, d):
    vectors = clustering.as_arrays(_order_vectors(spark, d))
    return rounded(density.dbscan(vectors, "order_id", "features", 0.5))


@query(
    "silhouette_exact",
    "WITH " + _PAIRS_SQL + """
    , m AS (SELECT a, la, lb, SUM(dist) AS t, COUNT(*) AS n FROM pairs GROUP BY 1, 2, 3),
    s AS (SELECT a, la, MAX(CASE WHEN la = lb AND n > 1 THEN t / (n - 1) END) AS x, MIN(CASE WHEN la <> lb THEN t / n END) AS y FROM m GROUP BY 1, 2)
    SELECT a AS vec_id, CAST(la AS INT) AS cluster, round(COALESCE((y - x) / greatest(x, y), 0), 6) AS silhouette FROM s""",
)
def silhouette_exact(spark, d):
    return rounded(clustering.silhouette_rows(_arrays(spark, d), "vec_id", "features", "label"))


@query(
    "ch_index",
    """WITH x AS (SELECT label, UNNEST(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
    c AS (SELECT label, dim, COUNT(*) AS n, AVG(v) AS m, SUM(v * v) AS q FROM x GROUP BY 1, 2),
    g AS (SELECT dim, AVG(v) AS m FROM x GROUP BY 1),
    t AS (SELECT SUM(n * (c.m - g.m) ** 2) AS ssb, SUM(q - n * c.m ** 2) AS ssw FROM c JOIN g USING (dim)),
    z AS (SELECT COUNT(*) AS n, COUNT(DISTINCT label) AS k FROM embeddings)
    SELECT n, k, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS calinski_harabasz FROM t, z""",
)
def ch_index(spark, d):
    vectors = _arrays(spark, d).select("label", array_to_vector("features").alias("features"))
    return rounded(clustering.calinski_harabasz(vectors, "features", "label"))


@query("kmeans_sweep")
def kmeans_sweep(spark, d):
    return clustering.evaluate_kmeans_range(_order_vectors(spark, d), 2, 5, n_init=2)[0]


@query("kmeans_labels")
def kmeans_labels(spark, d):
    vectors = _order_vectors(spark, d).cache()
    return clustering.fit_kmeans(vectors, 4).transform(vectors).select("order_id", "cluster_id")


@query("pca")
def pca(spark, d):
    og = settle(orders_grain(spark, d))
    vectors = FeaturePipeline(cyclical={"day_of_week": 7}).fit(og).vectors(og, ["order_id", "payment_name"])
    model, _ = projection.fit_pca(vectors, 3)
    return projection.project(model, vectors, ["order_id", "payment_name"], 3)


@query("pca_variance")
def pca_variance(spark, d):
    vectors = _arrays(spark, d).select(array_to_vector("features").alias("features"))
    return projection.components_for_variance(vectors)


@query("feature_set_experiments")
def feature_set_experiments(spark, d):
    og = settle(orders_grain(spark, d))
    small = reduce_cardinality(og, "delivery_type", 50)
    plain = {"cyclical": {}, "categorical": []}
    sets = {
        "full": FeaturePipeline().fit(og).vectors(og, ["order_id"]),
        "reduced": FeaturePipeline().fit(small).vectors(small, ["order_id"]),
        "numeric and cyclic": FeaturePipeline(categorical=[]).fit(og).vectors(og, ["order_id"]),
        "numeric": FeaturePipeline(**plain).fit(og).vectors(og, ["order_id"]),
    }
    return clustering.feature_set_experiments(sets, 2, 4, n_init=1)


@query("segmentation_run")
def segmentation_run(spark, d):
    enriched, _ = segment_orders(orders_grain(spark, d), _numeric_pipeline(), k_range=(2, 4), n_init=1)
    return enriched.select(
        "order_id", "order_amount_brutto", "n_items", "cluster_id", "segment", "dbscan_label", "is_noise", "pca_1", "pca_2", "pca_3"
    )
