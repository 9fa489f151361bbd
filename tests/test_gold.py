import datetime as dt
from decimal import Decimal

import pytest

from tidemark.plans import checks, gold, silver
from tidemark.warehouse import Warehouse


@pytest.fixture
def shop(bronze_rows):
    """A small shop: w(orders, items, payments, customers, products) of bronze dicts."""

    def make(orders=(), items=(), payments=(), customers=(), products=()):
        return Warehouse({
            "orders": bronze_rows("orders", *orders),
            "live_orders": bronze_rows("live_orders"),
            "order_items": bronze_rows("order_items", *items),
            "live_order_items": bronze_rows("live_order_items"),
            "order_payments": bronze_rows("order_payments", *payments),
            "live_order_payments": bronze_rows("live_order_payments"),
            "customers": bronze_rows("customers", *customers),
            "products": bronze_rows("products", *products),
            "product_category_translation": bronze_rows("product_category_translation"),
            "sellers": bronze_rows("sellers"),
        })

    return make


def order(oid, **more):
    return {"order_id": oid, "customer_id": f"c{oid}", "order_status": "delivered",
            "order_purchase_timestamp": "2024-01-01 10:00:00",
            "order_estimated_delivery_date": "2024-01-05 00:00:00", **more}


def item(oid, n=1, price="10.00", **more):
    return {"order_id": oid, "order_item_id": str(n), "product_id": "p1", "price": price,
            "freight_value": "1.00", **more}


def customer(oid, person, **more):
    return {"customer_id": f"c{oid}", "customer_unique_id": person, "customer_city": "x",
            "customer_state": "sp", "customer_zip_code_prefix": "1", **more}


def facts(w):
    return {r.order_id: r for r in w.fct_orders.collect()}


def test_order_without_items_or_payments(shop):
    r = facts(shop([order("1")], customers=[customer("1", "A")]))["1"]
    assert (r.item_count, r.order_total, r.payment_count, r.total_paid) == (0, 0, 0, 0)
    assert r.is_valid_for_revenue is False and r.has_negative_price is False


def test_items_and_payments_do_not_multiply(shop):
    payment = {"order_id": "1", "payment_type": "voucher", "payment_value": "11.00"}
    w = shop(
        [order("1")], [item("1", 1), item("1", 2)],
        [{**payment, "payment_sequential": "1"}, {**payment, "payment_sequential": "2"}],
        [customer("1", "A")],
    )
    r = facts(w)["1"]
    assert (r.item_count, r.order_total, r.total_paid) == (2, Decimal("22.00"), Decimal("22.00"))
    assert r.payment_gap == 0 and r.is_valid_for_revenue


def test_validity_is_three_valued(shop):
    w = shop(
        [order("ok"), order("neg"), order("gone", customer_id=""), order("pay"),
         order("no", order_status="canceled"), order("null", order_status=None),
         order("negnull", order_status=None), order("stranger")],
        [item(o) for o in ("ok", "gone", "pay", "no", "null", "stranger")]
        + [item("neg", price="-1"), item("negnull", price="-1")],
        [{"order_id": "pay", "payment_sequential": "1", "payment_type": "UPI"}],
        [customer(o, o) for o in ("ok", "neg", "pay", "no", "null", "negnull")],
    )
    valid = {k: r.is_valid_for_revenue for k, r in facts(w).items()}
    assert valid == {"ok": True, "neg": False, "gone": False, "pay": False, "no": False,
                     "null": None, "negnull": False, "stranger": True}
    stranger = facts(w)["stranger"]
    assert stranger.customer_unique_id is None and not stranger.is_missing_customer
    # An order of an unknown customer counts in three of the four totals.
    drift = checks.revenue_drift(gold.revenue_totals(
        w.fct_orders, w.mart_daily_revenue, w.mart_category_performance, w.dim_customers))
    assert drift.count() == 1


def test_delivery(shop):
    w = shop([
        order("same", order_delivered_customer_date="2024-01-05 23:00:00"),
        order("late", order_delivered_customer_date="2024-01-06 00:00:00"),
        order("fast", order_delivered_customer_date="2024-01-02 11:12:00"),
        order("open"),
    ])
    r = facts(w)
    assert [r[k].is_late_delivery for k in ("same", "late", "open")] == [False, True, None]
    assert r["fast"].delivery_days == Decimal("1.1") and r["open"].delivery_days is None


@pytest.mark.parametrize("price, segment", [
    ("0.00", "no_valid_orders"), ("0.01", "low"), ("199.99", "low"), ("200.00", "medium"),
    ("999.99", "medium"), ("1000.00", "high"),
])
def test_value_segments(shop, price, segment):
    w = shop([order("1")], [item("1", price=price, freight_value="0")], (), [customer("1", "A")])
    assert w.dim_customers.first().value_segment == segment


def test_customer_dimension_uses_latest_order(shop):
    w = shop(
        [order("1"), order("2", order_purchase_timestamp="2024-02-01 00:00:00"),
         order("3", order_status="canceled", order_purchase_timestamp="2024-01-20 00:00:00")],
        [item("1", price="10.00"), item("2", price="11.01"), item("3", price="500.00")], (),
        [customer("1", "A", customer_city="old"), customer("2", "A", customer_city="new"),
         customer("3", "A", customer_city="mid")],
    )
    r = w.dim_customers.collect()
    assert len(r) == 1
    r = r[0]
    assert (r.city, r.total_orders, r.valid_orders, r.is_repeat_customer) == ("New", 3, 2, True)
    assert r.lifetime_value == Decimal("23.01") and r.avg_order_value == Decimal("11.51")
    assert r.last_order_at == dt.datetime(2024, 2, 1)


def test_latest_order_without_date_wins(shop):
    w = shop(
        [order("1"), order("2", order_purchase_timestamp="")], [], (),
        [customer("1", "A", customer_city="dated"), customer("2", "A", customer_city="undated")],
    )
    assert w.dim_customers.first().city == "Undated"


def test_repeated_customer_id_keeps_the_grain(shop):
    w = shop([order("1")], [item("1")], (),
             [customer("1", "A", customer_city="a"), customer("1", "A", customer_city="b")])
    assert w.dim_customers.count() == 1


def test_product_dimension(shop):
    def product(pid, weight):
        return {"product_id": pid, "product_weight_g": weight, "product_length_cm": "2",
                "product_height_cm": "3", "product_width_cm": "4"}

    w = shop(products=[product(w or "none", w) for w in (None, "499", "500", "4999", "5000")])
    bands = {r.product_id: r.size_band for r in w.dim_products.collect()}
    assert bands == {"none": "unknown", "499": "small", "500": "medium", "4999": "medium",
                     "5000": "large"}
    assert w.dim_products.first().volume_cm3 == 24


def test_category_ranks(shop):
    w = shop(
        [order(str(n)) for n in range(1, 6)],
        [item("1", product_id="a"), item("2", product_id="b"), item("3", product_id="c", price="1"),
         item("4", product_id="d", price=""), item("5", product_id=None, price="2")],
        (), [customer(str(n), str(n)) for n in range(1, 6)],
        [{"product_id": p, "product_category_name": f"cat-{p}"} for p in "abcd"],
    )
    rows = {r.category: r for r in w.mart_category_performance.collect()}
    assert {k: r.revenue_rank for k, r in rows.items()} == {
        "cat-d": 1, "cat-a": 2, "cat-b": 2, "unknown": 4, "cat-c": 5}
    assert rows["cat-d"].avg_item_price is None and rows["cat-d"].revenue_share_pct is None
    assert rows["cat-a"].revenue_share_pct == Decimal("40.74")


def test_category_counts_every_person_of_an_order(shop):
    """A customer id that repeats gives an order a fact row for each person: both are counted, the order once."""
    w = shop(
        [order("1"), order("2")],
        [item("1", product_id="a"), item("1", "2", product_id="a"), item("2", product_id="a")], (),
        [customer("1", "A"), customer("1", "B"), customer("2", "B")],
        [{"product_id": "a", "product_category_name": "cat"}],
    )
    row = w.mart_category_performance.first()
    assert (row.orders, row.customers, row.units_sold) == (2, 2, 5)


def test_daily_revenue(shop):
    w = shop(
        [order("1"), order("2"), order("3", customer_id=""),
         order("4", order_purchase_timestamp="2024-01-02 00:00:00")],
        [item("1"), item("2"), item("3")], (),
        [customer("1", "A"), customer("2", "A"), customer("4", "B")],
    )
    rows = {str(r.order_date): r for r in w.mart_daily_revenue.collect()}
    first = rows["2024-01-01"]
    assert (first.total_orders, first.valid_orders, first.unique_customers) == (3, 2, 1)
    assert first.revenue == Decimal("22.00") and first.avg_order_value == Decimal("11.00")
    second = rows["2024-01-02"]
    assert second.revenue == 0 and second.avg_order_value is None
    assert second.late_delivery_pct is None


def test_all_silver_relations_have_a_builder():
    assert set(silver.SILVER) == {
        "stg_orders", "stg_order_items", "stg_order_payments",
        "stg_customers", "stg_products", "stg_sellers"}
