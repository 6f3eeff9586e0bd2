"""How the star-schema tables stand in for order data, in Spark and in SQL.

orders grain: ``orders`` with aggregated ``lineitem``; delivery type is the
order priority, payment name the order status.  items grain: ``lineitem`` with
``part``.  series: orders per day, one series per order priority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import casts
from orderloom.operators import orders as order_ops
from orderloom.operators import series as series_ops
from orderloom.sources.tables import read_table

KEYS = ["series"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded (and never -0.0), dates and timestamps as text."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind == "boolean":
            c = c.cast("int")
        columns.append(c.alias(name))
    return df.select(*columns)


def orders_grain(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice", "l_quantity"
    )
    stats = order_ops.flat_item_stats(
        lines, "o_orderkey", F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_quantity")
    )
    joined = order_ops.attach_item_stats(read_table(spark, d, "orders"), stats, "o_orderkey")
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        "o_custkey",
        F.col("o_orderdate").alias("date_add"),
        F.col("o_totalprice").alias("order_amount_brutto"),
        F.col("o_orderpriority").alias("delivery_type"),
        F.col("o_orderstatus").alias("payment_name"),
        "n_items",
        "avg_item_price",
        "max_item_price",
        "total_quantity",
        casts.day_of_week(F.col("o_orderdate")).alias("day_of_week"),
        F.month("o_orderdate").alias("month"),
    )


ORDERS_SQL = """
og AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey, o.o_orderdate AS date_add,
         o.o_totalprice AS order_amount_brutto, o.o_orderpriority AS delivery_type,
         o.o_orderstatus AS payment_name,
         COALESCE(l.n_items, 0) AS n_items, COALESCE(l.avg_item_price, 0) AS avg_item_price,
         COALESCE(l.max_item_price, 0) AS max_item_price, COALESCE(l.total_quantity, 0) AS total_quantity,
         CAST(isodow(o.o_orderdate) - 1 AS INT) AS day_of_week, CAST(month(o.o_orderdate) AS INT) AS month
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, COUNT(*) AS n_items, AVG(l_extendedprice / l_quantity) AS avg_item_price,
           MAX(l_extendedprice / l_quantity) AS max_item_price, CAST(SUM(l_quantity) AS BIGINT) AS total_quantity
    FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey)
"""


def keyed_orders(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("series"), "o_orderkey", "o_orderdate", "o_totalprice"
    )


def observed_days(spark: SparkSession, d: str) -> DataFrame:
    return series_ops.daily_sales(keyed_orders(spark, d), KEYS, "o_orderdate", "o_totalprice")


def daily_series(spark: SparkSession, d: str) -> DataFrame:
    """Gap-free series per order priority with zero on days without orders."""
    return series_ops.on_spine(observed_days(spark, d), KEYS, {"sales": 0.0})


DAILY_SQL = """
observed AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sales, COUNT(*) AS order_count
  FROM orders GROUP BY 1, 2),
spine AS (
  SELECT series, CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM observed GROUP BY series),
daily AS (
  SELECT s.series, s.date, COALESCE(o.sales, 0) AS sales
  FROM spine s LEFT JOIN observed o ON o.series = s.series AND o.date = s.date)
"""


def order_days(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders")


def item_names(spark: SparkSession, d: str) -> DataFrame:
    """Product names as the shop would write them: name, type, size number."""
    return read_table(spark, d, "part").select(
        "p_partkey",
        F.upper(F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string"))).alias("name"),
        F.col("p_brand").alias("products_sku"),
    )


ITEMS_SQL = """
names AS (
  SELECT p_partkey, upper(p_name || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR)) AS name,
         p_brand AS products_sku FROM part)
"""
