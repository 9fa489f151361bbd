import datetime as dt
import json
import logging
import os

import pytest

from tidemark.operators.history import read_history
from tidemark.operators.quality import ChecksFailed
from tidemark.plans import pipeline
from tidemark.sources import files, landing
from tidemark.sources.landing import ingest_landing
from tidemark.streaming import live

FILES = {
    "olist_customers_dataset.csv":
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,A,123,rio,rj\nc2,A,123,rio,rj\nc3,B,9,são paulo,sp\n",
    "olist_geolocation_dataset.csv": "geolocation_zip_code_prefix,geolocation_city\n123,rio\n",
    "olist_orders_dataset.csv":
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "1,c1,delivered,2024-01-01 10:00:00,,,2024-01-03 10:00:00,2024-01-09 00:00:00\n"
        "2,c2,shipped,2024-01-02 10:00:00,,,,2024-01-09 00:00:00\n",
    "olist_order_items_dataset.csv":
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "1,1,p1,s1,2024-01-05 00:00:00,10.00,1.00\n2,1,p1,s1,2024-01-05 00:00:00,20.00,2.00\n",
    "olist_order_payments_dataset.csv":
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "1,1,voucher,1,11.00\n2,1,boleto,1,22.00\n",
    "olist_order_reviews_dataset.csv":
        'review_id,review_comment_message\nr1,"good,\nvery good"\nr2,\n',
    "olist_products_dataset.csv":
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,moveis,1,1,1,600,1,2,3\n",
    "olist_sellers_dataset.csv":
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,rio,rj\n",
    "product_category_name_translation.csv":
        "product_category_name,product_category_name_english\nmoveis,furniture\n",
}


@pytest.fixture
def raw_dir(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / name).write_text(text, encoding="utf-8-sig")
    return str(folder)


def put(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_whole_run(lake, raw_dir, tmp_path):
    zone = tmp_path / "landing"
    first = pipeline.run(lake, raw_dir, str(zone), run_id="r1", item_buckets=2)
    assert first.count() == 41 and {r.status for r in first.collect()} == {"pass"}
    assert lake.read("bronze", "order_reviews").count() == 2
    day = {str(r.order_date): r for r in lake.read("gold", "mart_daily_revenue").collect()}
    assert str(day["2024-01-01"].revenue) == "11.00"
    category = lake.read("gold", "mart_category_performance").first()
    assert (category.category, category.units_sold, str(category.revenue_share_pct)) == (
        "furniture", 2, "100.00")

    put(zone / "orders", "o.jsonl",
        {"order_id": "3", "customer_id": "c3", "order_status": " APPROVED ",
         "order_purchase_timestamp": "2024-01-02T11:00:00Z"},
        {"order_id": "4", "customer_id": None, "order_status": "delivered",
         "order_purchase_timestamp": "2024-01-02T11:00:00Z"})
    put(zone / "order_items", "i.jsonl",
        {"order_id": "3", "order_item_id": 1, "product_id": "p1", "seller_id": "s1",
         "shipping_limit_date": "2024-01-05 00:00:00", "price": 30.5, "freight_value": 1})
    put(zone / "order_payments", "p.jsonl",
        {"order_id": "3", "payment_sequential": 1, "payment_type": "UPI", "payment_value": 31.5})
    second = {r.check: r for r in
              pipeline.run(lake, None, str(zone), run_id="r2", item_buckets=2).collect()}
    warned = {c for c, r in second.items() if r.status == "warn"}
    assert warned == {"not_flagged_stg_orders_is_missing_customer",
                      "not_flagged_stg_order_payments_is_unknown_payment_type",
                      "delivered_orders_have_delivery_date"}
    assert lake.read("audit", "delivered_orders_have_delivery_date").first().order_id == "4"
    assert lake.read("gold", "fct_orders").count() == 4
    assert lake.read("gold", "fct_order_items").count() == 3
    history = read_history(lake, "snap_customers")
    assert history.count() == 3 and history.where("valid_to IS NOT NULL").isEmpty()

    # Between full runs: a new item, and a newer copy of a history item.
    for name, order_id, price in (("j.jsonl", "4", "7.00"), ("k.jsonl", "1", "9.99")):
        put(zone / "order_items", name,
            {"order_id": order_id, "order_item_id": "1", "product_id": "p1", "seller_id": "s1",
             "shipping_limit_date": "", "price": price, "freight_value": "0"})
    ingest_landing(lake, str(zone), "r2b")
    pipeline.refresh_item_fact(lake, "r2b", item_buckets=2)
    prices = {r.order_id: str(r.price) for r in lake.read("gold", "fct_order_items").collect()}
    assert prices == {"1": "9.99", "2": "20.00", "3": "30.50", "4": "7.00"}

    put(zone / "orders", "x.jsonl", {"order_id": "5", "customer_id": "nobody",
                                     "order_purchase_timestamp": "2024-01-02 11:00:00"})
    with pytest.raises(ChecksFailed, match="relationships_stg_orders_customer_id"):
        pipeline.run(lake, None, str(zone), run_id="r3", item_buckets=2)


def test_undeclared_source(lake):
    with pytest.raises(KeyError):
        pipeline.bronze(lake, "order_reviews")


def test_stream_is_exactly_once(lake, tmp_path, bronze_rows):
    zone = tmp_path / "landing"
    history = bronze_rows("orders", {"order_id": "1", "order_status": "created"},
                          {"order_id": "2", "order_status": "created"})
    lake.replace("bronze", "orders", history, "h")

    def run(checkpoint):
        query = live.stream_landing(
            lake, str(zone), "orders", str(tmp_path / checkpoint), files_per_batch=1,
            upsert_buckets=2)
        query.awaitTermination()
        return {r.order_id: r.order_status
                for r in lake.read("silver", live.current_table("orders")).collect()}

    put(zone / "orders", "a.jsonl", {"order_id": "1", "order_status": "SHIPPED"})
    put(zone / "orders", "b.jsonl", {"order_id": "3", "order_status": "created"})
    put(zone / "orders", "c.jsonl.tmp", {"order_id": "9"})
    assert run("c1") == {"1": "shipped", "2": "created", "3": "created"}
    put(zone / "orders", "d.jsonl", {"order_id": "3", "order_status": "approved"})
    expected = {"1": "shipped", "2": "created", "3": "approved"}
    assert run("c1") == expected
    # A lost checkpoint announces every file again; the log keeps them from loading twice.
    assert run("c2") == expected
    assert landing.live_table(lake, "orders").count() == 3


def stream(lake, zone, checkpoint):
    live.stream_landing(
        lake, str(zone), "orders", str(checkpoint), files_per_batch=1, upsert_buckets=2
    ).awaitTermination()
    return {r.order_id: r.order_status
            for r in lake.read("silver", live.current_table("orders")).collect()}


def test_stream_takes_old_empty_changed_and_bad_files(lake, tmp_path, bronze_rows, caplog):
    zone = tmp_path / "landing"
    lake.replace("bronze", "orders", bronze_rows("orders", {"order_id": "1"}), "h")
    put(zone / "orders", "a.jsonl", {"order_id": "2", "order_status": "created"})
    assert set(stream(lake, zone, tmp_path / "c")) == {"1", "2"}
    put(zone / "orders", "old.jsonl", {"order_id": "3", "order_status": "created"})
    os.utime(zone / "orders" / "old.jsonl", (0, 0))
    (zone / "orders" / "empty.jsonl").touch()
    (zone / "orders" / "bad.jsonl").write_text("oops\n")
    put(zone / "orders", "a.jsonl", {"order_id": "2", "order_status": "shipped"})
    with caplog.at_level(logging.WARNING):
        got = stream(lake, zone, tmp_path / "c")
    assert got == {"1": None, "2": "created", "3": "created"}
    assert "changed after it was loaded" in caplog.text
    files = {r.source_file: r.row_count for r in landing.ingestion_log(lake).collect()}
    assert files == {"orders/a.jsonl": 1, "orders/old.jsonl": 1, "orders/empty.jsonl": 0}
    problems = [r.problem for r in lake.read("bronze", live.PROBLEM_TABLE).collect()]
    assert problems and all("bad.jsonl: invalid JSON on line 1" in p for p in problems)
    put(zone / "orders", "later.jsonl", {"order_id": "4", "order_status": "created"})
    assert set(stream(lake, zone, tmp_path / "c")) == {"1", "2", "3", "4"}


def test_history_reload_rebuilds_and_empty_loads_are_seen_once(lake, tmp_path, bronze_rows):
    zone = tmp_path / "landing"
    rows = bronze_rows("orders", {"order_id": "1"}, {"order_id": "2"})
    lake.replace("bronze", "orders", rows, "h1")
    put(zone / "orders", "a.jsonl", {"order_id": "3"})
    assert set(stream(lake, zone, tmp_path / "c")) == {"1", "2", "3"}
    lake.replace("bronze", "orders", bronze_rows("orders", {"order_id": "2"}), "h2")
    assert live.catch_up(lake, "orders", 2) == ["orders-h2"]
    table = live.current_table("orders")
    assert {r.order_id for r in lake.read("silver", table).collect()} == {"2", "3"}
    empty = landing.live_table(lake, "orders").limit(0)
    lake.commit(lake.stage("bronze", "live_orders", empty, "nothing", "append"))
    assert live.catch_up(lake, "orders", 2) == ["live_orders-nothing"]
    assert live.catch_up(lake, "orders", 2) == []


def test_item_fact_opens_new_loads_only_and_survives_compaction(lake, bronze_rows):
    def load(table, mode, version, *rows):
        at = rows[0]["_ingested_at"]
        lake.commit(lake.stage("bronze", table, bronze_rows(table, *rows), version, mode,
                               loaded_at=dt.datetime.fromisoformat(at)))

    def item(order_id, price, at):
        return {"order_id": order_id, "order_item_id": "1", "price": price, "freight_value": "1",
                "_ingested_at": at}

    def prices():
        return {r.order_id: str(r.price) for r in lake.read("gold", "fct_order_items").collect()}

    load("order_items", "replace", "h", item("1", "5", "2024-01-01T00:00:00+00:00"),
         item("2", "6", "2024-01-01T00:00:00+00:00"))
    pipeline.refresh_item_fact(lake, "r1", 4)
    assert pipeline.refresh_item_fact(lake, "r2", 4, lookback_hours=0) == {
        "parts": 0, "rows_written": 0}
    load("live_order_items", "append", "l1", item("2", "7", "2024-01-02T00:00:00+00:00"))
    lake.compact("gold", "fct_order_items", "packed")
    assert prices() == {"1": "5.00", "2": "6.00"}
    files.delete(lake.spark, f"{lake.table_path('bronze', 'order_items')}/version=h")  # not opened
    assert pipeline.refresh_item_fact(lake, "r3", 4, lookback_hours=0)["rows_written"] >= 1
    assert prices() == {"1": "5.00", "2": "7.00"}


def test_rebuild_of_the_item_fact(lake, bronze_rows):
    rows = {"order_id": "1", "order_item_id": "1", "price": "5", "freight_value": "1"}
    lake.replace("bronze", "order_items", bronze_rows("order_items", rows), "h1")
    pipeline.refresh_item_fact(lake, "r1", 4)
    lake.replace("bronze", "order_items", bronze_rows("order_items", {**rows, "order_id": "9"}), "h2")
    pipeline.refresh_item_fact(lake, "r2", 4, rebuild=True)
    assert [r.order_id for r in lake.read("gold", "fct_order_items").collect()] == ["9"]
