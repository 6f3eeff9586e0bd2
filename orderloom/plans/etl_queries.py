"""Ingestion: order documents, order grain, item grain, de-duplication."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orderloom.functions import casts
from orderloom.operators import orders as ops
from orderloom.plans.inputs import ORDERS_SQL, orders_grain, rounded
from orderloom.plans.registry import query
from orderloom.session import shared_folder
from orderloom.sources import xml
from orderloom.sources.tables import read_csv, read_table, save_csv

_ORDER_TIME = "dd.MM.yyyy HH:mm:ss"


def _nested(spark, d):
    """Orders with all their lines as text leaves; orders without lines give an empty ``rows``."""
    orders = read_table(spark, d, "orders")
    lines = read_table(spark, d, "lineitem")
    row = F.struct(
        F.col("l_partkey").cast("string").alias("products_id"),
        F.col("l_suppkey").cast("string").alias("auction_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("item_price_brutto"),
        F.col("l_quantity").cast("string").alias("quantity"),
    )
    # The lines of one order, which one document holds.
    listed = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(row).alias("_lines"))
    joined = orders.join(listed, "o_orderkey", "left")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format("o_orderdate", _ORDER_TIME).alias("date_add"),
        F.col("o_orderstatus").alias("payment_name"),
        F.lit("").alias("payment_status"),
        F.col("o_orderpriority").alias("delivery_type"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("order_amount_brutto"),
        F.struct(F.col("_lines").alias("row")).alias("rows"),
    )


def _documents(spark, d):
    """One XML document per order."""
    return xml.orders_to_column(_nested(spark, d))


_XML_ORDER = ["order_id", "date_add", "payment_name", "payment_status", "delivery_type", "order_amount_brutto"]
_XML_ITEM = ["products_id", "auction_id", "item_price_brutto", "quantity"]


@query(
    "order_xml_roundtrip",
    """
    SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id, substr(sha256(CAST(o.o_orderkey AS VARCHAR)), 1, 12) AS customer_id,
           CAST(o.o_orderdate AS VARCHAR) AS date_add, o.o_orderstatus AS payment_name, o.o_orderpriority AS delivery_type,
           0 AS payment_status, o.o_totalprice AS order_amount_brutto,
           COUNT(l.l_orderkey) AS n_items, round(COALESCE(AVG(l.l_extendedprice), 0) + 1e-9, 6) AS avg_item_price,
           round(COALESCE(MAX(l.l_extendedprice), 0), 6) AS max_item_price,
           CAST(COALESCE(SUM(l.l_quantity), 0) AS BIGINT) AS total_quantity
    FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    GROUP BY ALL
    """,
)
def order_xml_roundtrip(spark, d):
    raw = xml.orders_from_column(_documents(spark, d), "document", _XML_ORDER, _XML_ITEM)
    missing = {c: F.lit(None).cast("string") for c in xml.ORDER_FIELDS if c not in raw.columns}
    typed = ops.order_table(raw.withColumns(missing))
    out = typed.select(
        "order_id", "customer_id", "date_add", "payment_name", "delivery_type", "payment_status", "order_amount_brutto",
        F.col("n_items").cast("long").alias("n_items"), (F.col("avg_item_price") + 1e-9).alias("avg_item_price"), "max_item_price", "total_quantity",
    )
    return rounded(out)


_SUMS_SQL = """
    SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(o.o_orderdate AS VARCHAR) AS date_add, o.o_totalprice AS order_amount_brutto,
           COUNT(l.l_orderkey) AS n_items, CAST(COALESCE(SUM(l.l_quantity), 0) AS BIGINT) AS total_quantity
    FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY ALL
    """


def _out(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("xml_files_etl", _SUMS_SQL)
def xml_files_etl(spark, d):
    """All orders written as XML files, then the folder scanned, typed and saved by the ETL run."""
    folder = _out(spark, "order-files")
    _nested(spark, d).write.format("xml").option("rootTag", "orders").option("rowTag", "order").save(folder)
    saved = ops.run_etl(spark, folder, _out(spark, "order-table"))
    return rounded(saved.select("order_id", "date_add", "order_amount_brutto", F.col("n_items").cast("long").alias("n_items"), "total_quantity"))


@query("csv_reload", "SELECT o_orderkey, o_orderstatus, round(o_totalprice::DOUBLE, 6) AS o_totalprice, o_orderpriority FROM orders")
def csv_reload(spark, d):
    """Saved as CSV and read back with a schema."""
    kept = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority")
    return rounded(read_csv(spark, save_csv(kept, _out(spark, "orders-csv")), kept.schema))


@query(
    "slim_orders",
    """
    SELECT CAST(o.o_orderdate AS VARCHAR) AS date_add, o.o_totalprice AS order_amount_brutto,
           CAST(o.o_orderkey AS VARCHAR) AS order_id
    FROM orders o
    """,
)
def slim_orders(spark, d):
    fields = ["order_id", "date_add", "order_amount_brutto"]
    raw = xml.orders_from_column(_documents(spark, d), "document", fields, None)
    return rounded(ops.slim_table(raw))


@query(
    "order_items_agg",
    "WITH " + ORDERS_SQL + """
    SELECT order_id, n_items, round(avg_item_price + 1e-9, 6) AS avg_item_price,
           round(max_item_price, 8) AS max_item_price, total_quantity FROM og
    """,
)
def order_items_agg(spark, d):
    return rounded(
        orders_grain(spark, d).select("order_id", "n_items", "avg_item_price", "max_item_price", "total_quantity").withColumn("avg_item_price", F.round(F.col("avg_item_price") + 1e-9, 6)), 8
    )


@query(
    "order_clean",
    """
    SELECT substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 12) AS customer_id, o_orderkey AS order_id,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS VARCHAR) END AS date_add,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 0 END AS hour_of_day,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(isodow(o_orderdate) - 1 AS INT) END AS day_of_week,
           CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS amount,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(trunc(o_totalprice) AS INT) END AS amount_int,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS comment
    FROM orders
    """,
)
def order_clean(spark, d):
    """Texts with typical damage, repaired by the lenient casts."""
    raw = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "0000-00-00")
        .otherwise(F.date_format("o_orderdate", "d.M.yyyy H:m:s"))
        .alias("date_text"),
        F.when(F.col("o_orderstatus") == "P", "12,5x").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount_text"),
        F.when(F.col("o_orderstatus") == "F", " null ").otherwise(F.concat(F.lit("  "), "o_orderstatus")).alias("comment_text"),
    )
    ts = casts.parse_order_time(F.col("date_text"))
    out = raw.select(
        casts.customer_id(F.col("order_id").cast("string")).alias("customer_id"),
        "order_id",
        ts.alias("date_add"),
        casts.hour_of_day(ts).alias("hour_of_day"),
        casts.day_of_week(ts).alias("day_of_week"),
        casts.safe_float(F.col("amount_text")).alias("amount"),
        casts.safe_int(F.col("amount_text")).alias("amount_int"),
        casts.clean_text(F.col("comment_text")).alias("comment"),
    )
    return rounded(out)


@query(
    "item_rows",
    """
    SELECT substr(sha256(CAST(o.o_orderkey AS VARCHAR) || '|' || COALESCE(CAST(l.l_partkey AS VARCHAR), '') || '|' ||
                  COALESCE(CAST(l.l_suppkey AS VARCHAR), '')), 1, 16) AS item_id,
           CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(o.o_orderdate AS VARCHAR) AS date_add,
           CAST(l.l_partkey AS VARCHAR) AS products_id, COALESCE(l.l_extendedprice, 0) AS item_price_brutto,
           CAST(COALESCE(l.l_quantity, 0) AS INT) AS quantity, o.o_totalprice AS order_amount_brutto
    FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    """,
)
def item_rows(spark, d):
    raw = xml.orders_from_column(_documents(spark, d), "document", _XML_ORDER, _XML_ITEM)
    absent_order = {c: F.lit(None).cast("string") for c in xml.ORDER_FIELDS if c not in raw.columns}
    absent_item = [f for f in xml.ITEM_FIELDS if f not in _XML_ITEM]
    raw = raw.withColumns(absent_order).withColumn(
        "items",
        F.transform(
            "items",
            lambda i: F.struct(*[i[f].alias(f) for f in _XML_ITEM], *[F.lit(None).cast("string").alias(f) for f in absent_item]),
        ),
    )
    items = ops.item_table(raw)
    return rounded(
        items.select(
            "item_id", "order_id", "date_add", "products_id", "item_price_brutto", "quantity", "order_amount_brutto"
        )
    )


@query(
    "orders_dedup",
    """
    WITH first AS (
      SELECT l_orderkey AS order_id, l_partkey, l_linenumber, l_extendedprice,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn,
             COUNT(*) OVER (PARTITION BY l_orderkey) AS n_rows
      FROM lineitem)
    SELECT order_id, l_partkey, l_linenumber, l_extendedprice FROM first WHERE rn = 1
    """,
)
def orders_dedup(spark, d):
    lines = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    kept = ops.first_per_key(lines, ["order_id"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return rounded(kept.drop("l_suppkey"))


@query(
    "duplicate_orders",
    "SELECT CAST(COUNT(*) - COUNT(DISTINCT l_orderkey) AS BIGINT) AS n_duplicates FROM lineitem",
)
def duplicate_orders(spark, d):
    return ops.duplicate_count(read_table(spark, d, "lineitem"), ["l_orderkey"])


@query(
    "result_union",
    """
    SELECT o_orderkey AS order_id, 'orders' AS source_file, o_totalprice AS amount, NULL::DOUBLE AS discount FROM orders
    UNION ALL SELECT l_orderkey, 'lines', l_extendedprice, l_discount FROM lineitem
    """,
)
def result_union(spark, d):
    a = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.lit("orders").alias("source_file"), F.col("o_totalprice").alias("amount")
    )
    b = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.lit("lines").alias("source_file"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_discount").alias("discount"),
    )
    return rounded(ops.union_all(a, b))


@query(
    "filled_orders",
    "WITH " + ORDERS_SQL + """
    , stats AS (SELECT order_id, payment_name, n_items,
        CASE WHEN n_items = 0 THEN 'unknown' ELSE delivery_type END AS delivery_type, 0.0::DOUBLE AS vat_rate FROM og)
    SELECT order_id, delivery_type, n_items, vat_rate, payment_name FROM stats
    """,
)
def filled_orders(spark, d):
    """Null categories to "unknown", an absent feature to 0.0, leading columns first."""
    og = orders_grain(spark, d).select(
        "payment_name",
        "n_items",
        F.when(F.col("n_items") > 0, F.col("delivery_type")).alias("delivery_type"),
        "order_id",
    )
    filled = og.fillna({"delivery_type": "unknown"}).withColumn("vat_rate", F.lit(0.0))
    return ops.lead_columns(filled, ["order_id", "delivery_type", "n_items", "vat_rate"])
