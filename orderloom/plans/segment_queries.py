"""Order features and rank-based segments on a rule-made cluster id."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orderloom.functions import calendar
from orderloom.operators import features as ops
from orderloom.operators import segments
from orderloom.plans.inputs import ORDERS_SQL, orders_grain, rounded
from orderloom.plans.registry import query
from orderloom.session import settle
from orderloom.sources.tables import read_table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


@query(
    "log_cyclic",
    "WITH " + ORDERS_SQL + f"""SELECT order_id, round(ln(1 + order_amount_brutto), 6) AS order_amount_brutto, round(ln(1 + avg_item_price), 6) AS avg_item_price,
    round(sin(day_of_week * {2 * math.pi!r}::DOUBLE / 7), 6) + 0.0 AS day_of_week_sin, round(cos(day_of_week * {2 * math.pi!r}::DOUBLE / 7), 6) + 0.0 AS day_of_week_cos FROM og""",
)
def log_cyclic(spark, d):
    og = orders_grain(spark, d).select("order_id", "order_amount_brutto", "avg_item_price", "day_of_week")
    return rounded(calendar.encode_cyclic(calendar.log_columns(og, ["order_amount_brutto", "avg_item_price", "absent"])))


@query(
    "onehot",
    "SELECT o_orderkey, " + ", ".join(
        [f"CAST(o_orderpriority = '{v}' AS INT)::DOUBLE AS \"delivery_type_{v}\"" for v in PRIORITIES]
        + [f"CAST(o_orderstatus = '{v}' AS INT)::DOUBLE AS payment_name_{v}" for v in STATUSES]) + " FROM orders",
)
def onehot(spark, d):
    orders = read_table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("delivery_type"), F.col("o_orderstatus").alias("payment_name")
    )
    return rounded(ops.one_hot(orders, ops.learn_categories(orders, ops.CATEGORICAL)))


@query(
    "onehot_sparse",
    """SELECT o_orderkey, feature, 1.0::DOUBLE AS value FROM (
      SELECT o_orderkey, 'customer_' || CAST(o_custkey AS VARCHAR) AS feature FROM orders UNION ALL
      SELECT o_orderkey, 'delivery_type_' || o_orderpriority FROM orders UNION ALL SELECT o_orderkey, 'payment_name_' || o_orderstatus FROM orders)""",
)
def onehot_sparse(spark, d):
    """Long form: the places of each order's vector that are set, customers included."""
    orders = read_table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("delivery_type"), F.col("o_orderstatus").alias("payment_name")
    )
    model = ops.fit_sparse_one_hot(orders, ["customer", *ops.CATEGORICAL])
    names = spark.createDataFrame(list(enumerate(ops.sparse_names(model))), "at int, feature string")
    places = ops.set_places(ops.sparse_one_hot(model, orders), "onehot")
    return places.join(names, "at").select("o_orderkey", "feature", "value")


@query(
    "reduce_cardinality",
    """WITH c AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderkey, CASE WHEN n < 12 THEN 'Other' ELSE CAST(o_custkey AS VARCHAR) END AS customer FROM orders JOIN c USING (o_custkey)""",
)
def reduce_cardinality(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return ops.reduce_cardinality(orders, "customer", 12)


@query(
    "cardinality_sweep",
    """WITH c AS (SELECT 'o_custkey' AS column_name, COUNT(*) AS n FROM orders GROUP BY o_custkey
       UNION ALL SELECT 'o_orderdate', COUNT(*) FROM orders GROUP BY o_orderdate)
    SELECT column_name, CAST(t AS INT) AS threshold, CAST(COUNT(*) FILTER (n >= t) + CASE WHEN COUNT(*) FILTER (n < t) > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_categories
    FROM c, (SELECT UNNEST([5, 10, 15, 20]) AS t) GROUP BY 1, 2""",
)
def cardinality_sweep(spark, d):
    return ops.cardinality_sweep(read_table(spark, d, "orders"), ["o_custkey", "o_orderdate"], [5, 10, 15, 20])


FEATURE_SQL_COLUMNS = {
    "order_amount_brutto": "ln(1 + order_amount_brutto)",
    "n_items": "CAST(n_items AS DOUBLE)",
    "avg_item_price": "ln(1 + avg_item_price)",
    "max_item_price": "ln(1 + max_item_price)",
    "day_of_week_sin": f"sin(day_of_week * {2 * math.pi!r}::DOUBLE / 7)",
    "day_of_week_cos": f"cos(day_of_week * {2 * math.pi!r}::DOUBLE / 7)",
    **{f'"delivery_type_{v}"': f"CAST(delivery_type = '{v}' AS INT)" for v in PRIORITIES},
    **{f"payment_name_{v}": f"CAST(payment_name = '{v}' AS INT)" for v in STATUSES},
}


@query(
    "scaled_features",
    "WITH " + ORDERS_SQL + ", f AS (SELECT order_id, " + ", ".join(f"{e} AS {c}" for c, e in FEATURE_SQL_COLUMNS.items())
    + " FROM og) SELECT order_id, " + ", ".join(
        f"round(({c} - AVG({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in FEATURE_SQL_COLUMNS) + " FROM f",
)
def scaled_features(spark, d):
    og = settle(orders_grain(spark, d))
    pipeline = ops.FeaturePipeline().fit(og)
    vectors = pipeline.vectors(og, ["order_id"])
    return rounded(pipeline.named(vectors, ["order_id"]))


# A rule in place of a fitted model, so that the answer has one right value.
CLUSTER_RULE = """CASE WHEN n_items = 0 THEN -1 WHEN order_amount_brutto > 400000 AND n_items >= 5 THEN 5
  WHEN order_amount_brutto > 400000 THEN 4 WHEN n_items >= 7 THEN 3 WHEN n_items >= 4 THEN 2
  WHEN order_amount_brutto > 200000 THEN 1 ELSE 0 END"""
SUMMARY_SQL = ORDERS_SQL + f"""
, cl AS (SELECT *, {CLUSTER_RULE} AS cluster_id FROM og),
su AS (SELECT cluster_id, COUNT(*) AS size, AVG(order_amount_brutto) AS order_amount_brutto, AVG(n_items) AS n_items, AVG(avg_item_price) AS avg_item_price FROM cl GROUP BY 1)
"""
_SUMMARY = ["order_amount_brutto", "n_items", "avg_item_price"]


def ruled(spark, d):
    return orders_grain(spark, d).withColumn("cluster_id", F.expr(CLUSTER_RULE))


def summary(spark, d):
    return segments.cluster_summary(ruled(spark, d), _SUMMARY)


@query(
    "cluster_summary",
    "WITH " + SUMMARY_SQL + """SELECT cluster_id, size, round(order_amount_brutto, 4) AS order_amount_brutto, round(n_items, 4) AS n_items,
    round(avg_item_price, 4) AS avg_item_price, round(100.0 * size / SUM(size) OVER (), 4) AS pct FROM su""",
)
def cluster_summary(spark, d):
    from pyspark.sql import Window

    # One row per cluster, so one window over all of them is small.
    share = 100.0 * F.col("size") / F.sum("size").over(Window.partitionBy(F.lit(0)))
    return rounded(summary(spark, d).withColumn("pct", share), 4)


LABELS_SQL = SUMMARY_SQL + """
, nn AS (SELECT *, COUNT(*) OVER () AS k FROM su WHERE cluster_id <> -1),
r AS (SELECT cluster_id, size, (row_number() OVER (ORDER BY order_amount_brutto, cluster_id) - 1) / (k - 1) AS m,
   (row_number() OVER (ORDER BY n_items, cluster_id) - 1) / (k - 1) AS b FROM nn),
labels_ AS (SELECT cluster_id, CASE WHEN m >= 0.7 AND b < 0.3 THEN 'Premium Single-Item' WHEN m >= 0.7 AND b >= 0.7 THEN 'High-Value Multi-Item'
   WHEN m >= 0.7 THEN 'High Spenders' WHEN m < 0.3 AND b >= 0.7 THEN 'Budget Multi-Item' WHEN m < 0.3 AND b < 0.3 THEN 'Small Quick Purchases'
   WHEN m < 0.3 THEN 'Budget Shoppers' ELSE 'Standard Orders' END AS name, size, m AS monetary_rank, b AS basket_size_rank FROM r
   UNION ALL SELECT cluster_id, 'Outliers / Noise', size, -1.0, -1.0 FROM su WHERE cluster_id = -1)
"""


@query(
    "segment_labels",
    "WITH " + LABELS_SQL + "SELECT cluster_id, name, size, round(monetary_rank, 6) AS monetary_rank, round(basket_size_rank, 6) AS basket_size_rank FROM labels_",
)
def segment_labels(spark, d):
    return rounded(segments.label_clusters(summary(spark, d)).drop("description"))


@query(
    "segment_rows",
    "WITH " + LABELS_SQL + "SELECT order_id, cluster_id, name AS segment FROM cl LEFT JOIN labels_ USING (cluster_id)",
)
def segment_rows(spark, d):
    rows = ruled(spark, d).select("order_id", "cluster_id")
    return segments.attach_labels(rows, segments.label_clusters(summary(spark, d)), unknown="Unknown").select(
        "order_id", "cluster_id", "segment"
    )


@query(
    "radar_minmax",
    "WITH " + SUMMARY_SQL + " UNION ALL ".join(
        f"""SELECT cluster_id, '{f}' AS feature, round(CASE WHEN MAX({f}) OVER () > MIN({f}) OVER () THEN ({f} - MIN({f}) OVER ()) / (MAX({f}) OVER () - MIN({f}) OVER ())
        ELSE 0.0 END, 6) + 0.0 AS value FROM su WHERE cluster_id <> -1""" for f in _SUMMARY),
)
def radar_minmax(spark, d):
    return rounded(segments.radar(summary(spark, d), _SUMMARY))
