"""Lenient and strict casts, identifiers, and order-time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number texts accepted by the lenient casts: plain decimals with an optional
# exponent, and the words nan / inf / infinity.  The JVM parser would also take
# type suffixes such as "1d", which order documents must not use.
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NUMBER_WORD = r"(?i)^[+-]?(nan|inf|infinity)$"

# Fixed value: the date layout of the order documents.  Single letters accept
# both "05.06.2025" and "5.6.2025".
ORDER_TIME_FORMAT = "d.M.yyyy H:m:s"


def try_float(text: Column) -> Column:
    """Double, or null where the text is not a number."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER_TEXT) | trimmed.rlike(NUMBER_WORD), trimmed.try_cast("double"))


def safe_float(text: Column) -> Column:
    """Double, or 0.0 where the text is missing or not a number."""
    return F.coalesce(try_float(text), F.lit(0.0))


def safe_int(text: Column) -> Column:
    """Integer truncated toward zero, or 0 where that is impossible."""
    return F.coalesce(try_float(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def strict_int(text: Column) -> Column:
    """Null becomes 0; text that is not a number fails the query."""
    return F.when(text.isNull(), F.lit(0)).otherwise(text.cast("double").cast("int"))


def parse_order_time(text: Column) -> Column:
    """Timestamp, or null where the text does not follow the order layout."""
    return F.try_to_timestamp(text, F.lit(ORDER_TIME_FORMAT))


def parse_order_time_strict(text: Column) -> Column:
    """Timestamp; a text of another layout fails the query."""
    return F.to_timestamp(text, ORDER_TIME_FORMAT)


def clean_text(text: Column) -> Column:
    """Trimmed text; empty text and any spelling of NULL become null."""
    trimmed = F.trim(text)
    return F.when((trimmed != "") & (F.upper(trimmed) != "NULL"), trimmed)


def blank_to_null(text: Column) -> Column:
    """Empty text becomes null, everything else is kept untouched."""
    return F.when(text != "", text)


def customer_id(order_id: Column) -> Column:
    """First 12 hex digits of the SHA-256 of the order id."""
    return F.substring(F.sha2(order_id, 256), 1, 12)


def item_id(order_id: Column, product_id: Column, auction_id: Column) -> Column:
    """First 16 hex digits of the SHA-256 of ``order|product|auction``.

    Equal for two lines of one order that carry the same product, so it is not
    a row key; keep the line position for that.
    """
    parts = [F.coalesce(c, F.lit("")) for c in (order_id, product_id, auction_id)]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def money_sum(amount: Column, scale: int = 6) -> Column:
    """Exact sum of an amount with up to ``scale`` decimals, independent of the order of rows."""
    return F.sum(amount.cast(f"decimal({18 + scale},{scale})")).cast("double")
