"""Order-grain and item-grain tables from nested or flat order data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import casts

# Names and order of the output columns.
ORDER_COLUMNS = [
    "customer_id",
    "order_id",
    "date_add",
    "payment_name",
    "payment_status",
    "payment_paid",
    "delivery_type",
    "delivery_price",
    "client_city",
    "order_amount_brutto",
    "n_items",
    "avg_item_price",
    "max_item_price",
    "total_quantity",
    "hour_of_day",
    "day_of_week",
]
ITEM_LEAD = ["item_id", "order_id", "name", "products_sku"]


def lead_columns(df: DataFrame, lead: list[str]) -> DataFrame:
    """Named columns first (where present), the rest in their order."""
    first = [c for c in lead if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def nested_item_stats(items: Column) -> dict[str, Column]:
    """Line aggregates of an array column without exploding it."""
    prices = F.transform(items, lambda i: casts.safe_float(i["item_price_brutto"]))
    quantities = F.transform(items, lambda i: casts.safe_int(i["quantity"]).cast("long"))
    count = F.coalesce(F.size(items), F.lit(0))
    total = F.aggregate(prices, F.lit(0.0), lambda a, b: a + b)
    return {
        "n_items": F.greatest(count, F.lit(0)),
        "avg_item_price": F.when(count > 0, total / count).otherwise(F.lit(0.0)),
        "max_item_price": F.coalesce(F.array_max(prices), F.lit(0.0)),
        "total_quantity": F.coalesce(F.aggregate(quantities, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0)),
    }


def flat_item_stats(items: DataFrame, key: str, price: Column, quantity: Column) -> DataFrame:
    """The same aggregates from one row per line; combines before the shuffle."""
    value = F.coalesce(price, F.lit(0.0))
    return items.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.avg(value).alias("avg_item_price"),
        F.max(value).alias("max_item_price"),
        F.sum(F.coalesce(quantity, F.lit(0)).cast("long")).alias("total_quantity"),
    )


def attach_item_stats(orders: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Left join; orders without lines get zeros."""
    return orders.join(stats, key, "left").fillna(
        {"n_items": 0, "avg_item_price": 0.0, "max_item_price": 0.0, "total_quantity": 0}
    )


def order_table(raw: DataFrame) -> DataFrame:
    """Typed order grain from nested order rows (all leaves text)."""
    ts = casts.parse_order_time(F.col("date_add"))
    typed = {
        "customer_id": casts.customer_id(F.coalesce("order_id", F.lit(""))),
        "order_id": F.col("order_id"),
        "date_add": ts,
        "payment_name": F.col("payment_name"),
        "payment_status": casts.strict_int(F.col("payment_status")),
        "payment_paid": casts.safe_float(F.col("payment_paid")),
        "delivery_type": F.col("delivery_type"),
        "delivery_price": casts.safe_float(F.col("delivery_price")),
        "client_city": F.col("client_city"),
        "order_amount_brutto": casts.safe_float(F.col("order_amount_brutto")),
        **nested_item_stats(F.col("items")),
        "hour_of_day": casts.hour_of_day(ts),
        "day_of_week": casts.day_of_week(ts),
    }
    return raw.select(*[typed[c].alias(c) for c in ORDER_COLUMNS])


def item_table(raw: DataFrame) -> DataFrame:
    """One row per line; an order without lines keeps one row of null item fields."""
    order_fields = ["order_id", "date_add", "payment_name", "delivery_type", "client_city",
                    "order_amount_brutto", "buyer_comments", "seller_comments"]
    flat = raw.select(*order_fields, F.posexplode_outer("items").alias("line_position", "_item"))
    flat = flat.select(*order_fields, "line_position", "_item.*")
    floats = ["item_price_brutto", "amount_brutto", "vat_rate", "order_amount_brutto"]
    columns = {
        "item_id": casts.item_id(F.col("order_id"), F.col("products_id"), F.col("auction_id")),
        "date_add": casts.parse_order_time(F.col("date_add")),
        "quantity": casts.safe_int(F.col("quantity")),
        **{c: casts.safe_float(F.col(c)) for c in floats},
        **{c: casts.clean_text(F.col(c)) for c in ["name", "products_sku", "buyer_comments", "seller_comments"]},
    }
    return lead_columns(flat.withColumns(columns), ITEM_LEAD)


def slim_table(raw: DataFrame) -> DataFrame:
    """Date and amount only; both must be present, and both must parse."""
    kept = raw.where((F.col("date_add") != "") & (F.col("order_amount_brutto") != ""))
    return kept.select(
        casts.parse_order_time_strict(F.col("date_add")).alias("date_add"),
        F.col("order_amount_brutto").cast("double").alias("order_amount_brutto"),
        *[c for c in ("order_id", "source_file") if c in raw.columns],
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row of each key by ``order``.

    ``min_by`` keeps one candidate per key on the map side, so a key that holds
    a large part of the rows never gathers in one task.
    """
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
    return kept.select("_row.*")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum(F.col("_n") - 1).alias("n_duplicates"))


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def run_etl(spark, folder: str, out: str, pattern: str = "*.xml", grain: str = "order") -> DataFrame:
    """Scan, type and save one grain; returns the saved table."""
    from orderloom.sources import tables, xml

    raw = xml.read_orders(spark, folder, pattern)
    table = order_table(raw) if grain == "order" else item_table(raw)
    return spark.read.parquet(tables.save_parquet(table, out))
