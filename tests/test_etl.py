from datetime import datetime

import pytest
from conftest import document, item, order
from pyspark.sql import functions as F

from orderloom.functions import casts
from orderloom.operators import orders as ops
from orderloom.sources import tables, xml


def test_order_grain(spark, order_folder):
    rows = {r.order_id: r for r in ops.order_table(xml.read_orders(spark, str(order_folder))).collect()}
    assert len(rows) == 4
    first = rows["100001"]
    assert (first.n_items, first.avg_item_price, first.max_item_price, first.total_quantity) == (2, 75.0, 100.0, 3)
    assert (first.hour_of_day, first.day_of_week) == (14, 6)
    assert first.date_add == datetime(2025, 6, 15, 14, 30)
    assert len(first.customer_id) == 12
    third = rows["100003"]
    assert (third.avg_item_price, third.total_quantity) == (0.0, 1)
    assert third.date_add == datetime(2025, 6, 25, 22, 5, 10)
    empty = rows["999999"]
    assert (empty.n_items, empty.avg_item_price, empty.order_amount_brutto, empty.payment_status) == (0, 0.0, 0.0, 0)
    assert empty.date_add is None and empty.client_city is None


def test_item_grain(spark, order_folder):
    items = ops.item_table(xml.read_orders(spark, str(order_folder)))
    assert items.columns[:4] == ["item_id", "order_id", "name", "products_sku"]
    rows = items.collect()
    assert len(rows) == 5
    lone = [r for r in rows if r.order_id == "999999"][0]
    assert lone.name is None and lone.line_position is None and lone.quantity == 0
    assert all(len(r.item_id) == 16 for r in rows)
    assert all(r.seller_comments is None and r.buyer_comments is None for r in rows)


def test_copies_are_kept_and_can_be_dropped(spark, order_folder):
    (order_folder / "b.xml").write_text((order_folder / "a.xml").read_text(encoding="utf-8"), encoding="utf-8")
    raw = xml.read_orders(spark, str(order_folder))
    assert raw.count() == 8
    assert ops.duplicate_count(raw, ["order_id"]).first().n_duplicates == 4
    kept = ops.first_per_key(raw, ["order_id"], ["source_file"])
    assert {r.source_file for r in kept.collect()} == {"a.xml"} and kept.count() == 4


def test_missing_and_malformed_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        xml.read_orders(spark, str(tmp_path))
    with pytest.raises(Exception):
        xml.read_orders(spark, str(tmp_path / "nowhere"))
    (tmp_path / "bad.xml").write_text("<orders><order><order_id>1</order>", encoding="utf-8")
    with pytest.raises(Exception):
        xml.read_orders(spark, str(tmp_path)).collect()


def test_empty_document(spark, tmp_path):
    (tmp_path / "e.xml").write_text("<orders></orders>", encoding="utf-8")
    table = ops.order_table(xml.read_orders(spark, str(tmp_path)))
    assert table.count() == 0 and table.columns == ops.ORDER_COLUMNS


def test_text_is_not_trimmed_by_the_reader(spark, tmp_path):
    (tmp_path / "t.xml").write_text(document([order("1", "1.1.2025 1:1:1", "1", [item("  A  ", "1", "1")], client_city=" Łódź ")]), encoding="utf-8")
    row = xml.read_orders(spark, str(tmp_path)).first()
    assert row.client_city == " Łódź " and row["items"][0].name == "  A  "


def test_slim_table_is_strict(spark, order_folder):
    slim = ops.slim_table(xml.read_orders(spark, str(order_folder), order_fields=["order_id", "date_add", "order_amount_brutto"], item_fields=None))
    assert slim.count() == 3
    (order_folder / "bad.xml").write_text(document([order("5", "1.1.2025 1:1:1", "12,5", [])]), encoding="utf-8")
    with pytest.raises(Exception):
        ops.slim_table(xml.read_orders(spark, str(order_folder))).collect()


def test_run_etl_and_sinks(spark, order_folder, tmp_path):
    saved = ops.run_etl(spark, str(order_folder), str(tmp_path / "deep" / "orders"))
    assert saved.count() == 4
    again = ops.run_etl(spark, str(order_folder), str(tmp_path / "deep" / "orders"), grain="item")
    assert again.count() == 5
    path = tables.save_csv(spark.range(3).withColumn("v", F.lit(1.5)), str(tmp_path / "csv"))
    assert sorted(map(tuple, tables.read_csv(spark, path, "id long, v double").collect())) == [(0, 1.5), (1, 1.5), (2, 1.5)]


def test_casts(spark):
    texts = ["1.5", " 2 ", "12,5", "", None, "1d", "nan", "-3.9", "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(casts.safe_float(F.col("t")), casts.safe_int(F.col("t"))).collect()]
    floats = [g[0] for g in got]
    assert floats[:6] == [1.5, 2.0, 0.0, 0.0, 0.0, 0.0] and floats[6] != floats[6] and floats[7:] == [-3.9, 1000.0]
    assert [g[1] for g in got] == [1, 2, 0, 0, 0, 0, 0, -3, 1000]
    cleaned = [r[0] for r in spark.createDataFrame([(" x ",), ("NuLL",), ("",), (None,)], "t string").select(casts.clean_text(F.col("t"))).collect()]
    assert cleaned == ["x", None, None, None]
    with pytest.raises(Exception):
        df.select(casts.strict_int(F.col("t"))).collect()


def test_lenient_reader_sets_bad_files_aside(spark, order_folder):
    (order_folder / "bad.xml").write_text("<orders><order><order_id>1</order_id></order><order><order_id>2</order></orders>", encoding="utf-8")
    good, quarantine = xml.read_orders_lenient(spark, str(order_folder))
    assert {r.source_file for r in good.collect()} == {"a.xml"} and good.count() == 4
    assert {r.source_file for r in quarantine.collect()} == {"bad.xml"}
