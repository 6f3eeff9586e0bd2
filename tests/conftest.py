import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]")
    session.sparkContext.setLogLevel("ERROR")
    return session


def element(tag, value):
    if isinstance(value, list):
        return f"<{tag}>" + "".join(element("row", v) for v in value) + f"</{tag}>"
    if isinstance(value, dict):
        return f"<{tag}>" + "".join(element(k, v) for k, v in value.items()) + f"</{tag}>"
    return f"<{tag}>{value}</{tag}>"


def order(order_id, date_add, amount, rows, **more):
    base = {
        "client_id": "c1", "order_id": order_id, "date_add": date_add, "payment_name": "Przelew", "payment_status": "1",
        "payment_paid": amount, "delivery_type": "Kurier", "delivery_price": "9.99", "buyer_comments": "", "seller_comments": " null ",
        "client_city": "Warszawa", "order_amount_brutto": amount,
    }
    return {**base, **more, "rows": rows}


def item(name, price, quantity, **more):
    return {"name": name, "products_id": "7", "products_sku": "OPT1", "auction_id": "a1", "item_price_brutto": price, "quantity": quantity, **more}


def document(orders):
    return '<?xml version="1.0" encoding="UTF-8"?>\n<orders>\n' + "\n".join(element("order", o) for o in orders) + "\n</orders>\n"


@pytest.fixture
def order_folder(tmp_path):
    orders = [
        order("100001", "15.06.2025 14:30:00", "150.00", [item("BOTKI CZARNE 38", "100.00", "1"), item("PASTA", "50.00", "2")]),
        order("100002", "20.06.2025 09:15:22", "300.50", [item("KOZAKI", "300.50", "1")]),
        order("100003", "25.6.2025 22:5:10", "89.99", [item("KLAPKI", "bad", "1.9")]),
        order("999999", "", "", [], delivery_price="", payment_status="", payment_paid="", client_city=""),
    ]
    (tmp_path / "a.xml").write_text(document(orders), encoding="utf-8")
    return tmp_path
