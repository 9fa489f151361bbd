import datetime as dt
from decimal import Decimal

from tidemark.plans import silver


def test_orders_are_cleaned_and_the_newest_copy_wins(bronze_rows):
    history = bronze_rows(
        "orders",
        {"order_id": " a ", "customer_id": "c1", "order_status": "created",
         "order_purchase_timestamp": "2024-01-01 10:00:00", "order_approved_at": ""},
        {"order_id": "b", "customer_id": "  ", "order_status": " APPROVED "},
    )
    live = bronze_rows(
        "live_orders",
        {"order_id": "a", "customer_id": "c1", "order_status": "delivered",
         "order_purchase_timestamp": "2024-01-01T10:00:00Z",
         "_ingested_at": "2024-01-02T00:00:00+00:00", "_source_file": "orders/x.jsonl"},
        {"order_id": "c", "customer_id": ""}, {"order_id": "d", "customer_id": None},
    )
    rows = {r.order_id: r for r in silver.stg_orders(history, live).collect()}
    assert set(rows) == {"a", "b", "c", "d"}
    assert rows["a"].order_status == "delivered" and rows["a"].source_system == "live"
    assert rows["a"].purchased_at == dt.datetime(2024, 1, 1, 10)
    assert rows["a"].approved_at is None and not rows["a"].is_missing_customer
    assert rows["b"].order_status == "approved"
    assert all(rows[k].customer_id is None and rows[k].is_missing_customer for k in "bcd")


def test_copy_without_load_time_counts_as_newest(bronze_rows):
    history = bronze_rows(
        "orders",
        {"order_id": "a", "order_status": "created"},
        {"order_id": "a", "order_status": "shipped", "_ingested_at": None},
    )
    rows = silver.stg_orders(history, bronze_rows("live_orders")).collect()
    assert [r.order_status for r in rows] == ["shipped"]


def test_same_load_time_is_decided_by_file_name(bronze_rows):
    live = bronze_rows(
        "live_orders",
        {"order_id": "a", "order_status": "created", "_source_file": "orders/1.jsonl"},
        {"order_id": "a", "order_status": "shipped", "_source_file": "orders/2.jsonl"},
    )
    rows = silver.stg_orders(bronze_rows("orders"), live).collect()
    assert [r.order_status for r in rows] == ["shipped"]


def test_equal_copies_in_one_file_leave_one_row(bronze_rows):
    row = {"order_id": "a", "order_status": "created"}
    assert silver.stg_orders(bronze_rows("orders", row, row), bronze_rows("live_orders")).count() == 1


def test_items(bronze_rows):
    item = {"order_id": "a", "order_item_id": "1", "product_id": "p", "seller_id": " ",
            "shipping_limit_date": "2024-01-05 00:00:00", "price": "-12.50", "freight_value": "2"}
    history = bronze_rows("order_items", item, {**item, "order_item_id": "2", "price": ""})
    rows = {r.order_item_id: r for r in
            silver.stg_order_items(history, bronze_rows("live_order_items")).collect()}
    assert rows[1].is_negative_price and rows[1].item_total == Decimal("-10.50")
    assert rows[1].seller_id is None
    assert rows[2].price is None and rows[2].item_total is None and rows[2].is_negative_price is None


def test_payments(bronze_rows):
    history = bronze_rows(
        "order_payments",
        {"order_id": "a", "payment_sequential": "1", "payment_type": "UPI", "payment_value": "1"},
        {"order_id": "a", "payment_sequential": "2", "payment_type": " Boleto"},
        {"order_id": "a", "payment_sequential": "3", "payment_type": None},
    )
    rows = {r.payment_sequential: r for r in
            silver.stg_order_payments(history, bronze_rows("live_order_payments")).collect()}
    assert (rows[1].payment_type, rows[1].is_unknown_payment_type) == ("upi", True)
    assert (rows[2].payment_type, rows[2].is_unknown_payment_type) == ("boleto", False)
    assert rows[3].is_unknown_payment_type is None


def test_places(bronze_rows):
    customers = silver.stg_customers(bronze_rows("customers", {
        "customer_id": " c ", "customer_unique_id": "p", "customer_zip_code_prefix": "123",
        "customer_city": " são-paulo d'oeste ", "customer_state": " sp"}))
    r = customers.first()
    assert (r.customer_id, r.zip_code_prefix, r.city, r.state) == (
        "c", "00123", "São-Paulo D'Oeste", "SP")
    seller = silver.stg_sellers(bronze_rows("sellers", {
        "seller_id": "s", "seller_zip_code_prefix": "123456", "seller_city": "RIO",
        "seller_state": "rj"})).first()
    assert (seller.zip_code_prefix, seller.city, seller.state) == ("12345", "Rio", "RJ")


def test_product_categories(bronze_rows):
    products = bronze_rows(
        "products",
        {"product_id": "1", "product_category_name": " moveis "},
        {"product_id": "2", "product_category_name": "novo"},
        {"product_id": "3"},
        {"product_id": "4", "product_category_name": "  ", "product_weight_g": "12"},
    )
    translations = bronze_rows("product_category_translation", {
        "product_category_name": "moveis", "product_category_name_english": " furniture"})
    rows = {r.product_id: r for r in silver.stg_products(products, translations).collect()}
    assert (rows["1"].category, rows["1"].is_missing_translation) == ("furniture", False)
    assert (rows["2"].category, rows["2"].is_missing_translation) == ("novo", True)
    assert (rows["3"].category, rows["3"].is_missing_translation) == ("unknown", False)
    assert (rows["4"].category, rows["4"].is_missing_translation) == ("", True)
    assert rows["4"].weight_g == 12
