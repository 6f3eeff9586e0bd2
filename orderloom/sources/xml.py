"""Order documents: XML files and XML text columns to nested order rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import settle

# Field names of the order documents.
ORDER_FIELDS = [
    "client_id",
    "order_id",
    "date_add",
    "payment_name",
    "payment_status",
    "payment_paid",
    "delivery_type",
    "delivery_price",
    "buyer_comments",
    "seller_comments",
    "client_city",
    "order_amount_brutto",
]
ITEM_FIELDS = [
    "name",
    "products_id",
    "products_ean",
    "products_sku",
    "auction_id",
    "item_price_brutto",
    "quantity",
    "amount_brutto",
    "vat_rate",
    "symkar",
]

_OPTIONS = {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}


def _text_struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def order_schema(order_fields: list[str] = ORDER_FIELDS, item_fields: list[str] | None = ITEM_FIELDS) -> T.StructType:
    """Explicit schema of one ``<order>``; every leaf is text."""
    schema = _text_struct(order_fields)
    if item_fields:
        schema.add("rows", T.StructType([T.StructField("row", T.ArrayType(_text_struct(item_fields)))]))
    return schema


def _leaf(column: Column) -> Column:
    return F.when(column != "", column)


def tidy_orders(df: DataFrame, order_fields: list[str], item_fields: list[str] | None) -> DataFrame:
    """Empty leaves to null, and the ``rows.row`` list to a plain ``items`` array."""
    passed = [c for c in df.columns if c not in order_fields and c != "rows"]
    columns = [F.col(c) for c in passed] + [_leaf(F.col(c)).alias(c) for c in order_fields]
    if item_fields:
        columns.append(
            F.transform(
                "rows.row",
                lambda r: F.struct(*[_leaf(r[f]).alias(f) for f in item_fields]),
            ).alias("items")
        )
    return df.select(*columns)


def read_orders(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.xml",
    order_fields: list[str] = ORDER_FIELDS,
    item_fields: list[str] | None = ITEM_FIELDS,
) -> DataFrame:
    """All orders of all matching files, with the file name; no de-duplication.

    A missing folder or a pattern without matches is an error, and so is a
    malformed document.
    """
    require_files(spark, folder, pattern)
    raw = (
        spark.read.format("xml")
        .options(**_OPTIONS)
        .option("rowTag", "order")
        .option("pathGlobFilter", pattern)
        .schema(order_schema(order_fields, item_fields))
        .load(folder)
    )
    raw = raw.withColumn("source_file", F.col("_metadata.file_name"))
    return tidy_orders(raw, order_fields, item_fields)


def read_orders_lenient(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.xml",
    order_fields: list[str] = ORDER_FIELDS,
    item_fields: list[str] | None = ITEM_FIELDS,
) -> tuple[DataFrame, DataFrame]:
    """(orders of readable documents, quarantine of (source_file, document)).

    A file with a malformed document gives no orders at all; its broken
    documents go to the quarantine.
    """
    require_files(spark, folder, pattern)
    schema = order_schema(order_fields, item_fields).add("_corrupt", T.StringType())
    raw = (
        spark.read.format("xml")
        .options(**{**_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        .option("rowTag", "order")
        .option("pathGlobFilter", pattern)
        .schema(schema)
        .load(folder)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )
    # Parsed once for both outputs; Spark also refuses to scan for the corrupt column alone.
    raw = settle(raw)
    quarantine = raw.where("_corrupt is not null").select("source_file", F.col("_corrupt").alias("document"))
    bad_files = quarantine.select("source_file").distinct()
    good = raw.drop("_corrupt").join(bad_files, "source_file", "left_anti")
    return tidy_orders(good, order_fields, item_fields), quarantine


def require_files(spark: SparkSession, folder: str, pattern: str) -> None:
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    if listing.isEmpty():
        raise FileNotFoundError(f"no files match {pattern} in {folder}")


def orders_from_column(
    df: DataFrame,
    column: str,
    order_fields: list[str] = ORDER_FIELDS,
    item_fields: list[str] | None = ITEM_FIELDS,
) -> DataFrame:
    """Parse one ``<order>`` document per row of a text column."""
    schema = order_schema(order_fields, item_fields)
    parsed = df.select(F.from_xml(F.col(column), schema, {**_OPTIONS, "rowTag": "order"}).alias("_order"))
    return tidy_orders(parsed.select("_order.*"), order_fields, item_fields)


def orders_to_column(df: DataFrame, column: str = "document") -> DataFrame:
    """Render each nested row as an ``<order>`` document (test and export side)."""
    return df.select(F.to_xml(F.struct("*"), {"rowTag": "order"}).alias(column))
