"""Bitmaps are built where all numbers of theirs meet, and facts are joined once a run."""

from pyspark.sql import functions as F

from tidemark.plans import gold
from tidemark.plans import incremental_marts as m
from tidemark.sources import key_index


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def _only_rows_are_shuffled(df):
    """Every aggregate of bitmaps stands above the one exchange of rows."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    return plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in below


def test_filters_hold_every_key_and_shuffle_hashes_only(spark):
    rows = spark.range(9000).select(
        (F.col("id") % 3).cast("string").alias("part"), F.when(F.col("id") > 4, F.col("id")).alias("k"))
    blocks = {"0": 2, "1": 1, "2": 3}
    filters = key_index.filters_of(rows, ["k"], blocks)
    assert _only_rows_are_shuffled(filters)
    bits = {(r.part, r.block): bytes(r.bits) for r in filters.collect()}
    sizes = F.create_map(*[x for p, n in blocks.items() for x in (F.lit(p), F.lit(n))])
    h = F.xxhash64("k")
    keys = rows.where("k IS NOT NULL").select(
        "part", key_index._block(h, sizes[F.col("part")]).alias("block"),
        F.array(*[key_index._bit(h, i) for i in range(key_index.PROBES)]).alias("at")).collect()
    expected = {}
    for r in keys:
        expected.setdefault((r.part, r.block), set()).update(r.at)
    set_bits = {k: {i for i in range(key_index.BLOCK_BITS) if v[i >> 3] >> (i & 7) & 1} for k, v in bits.items()}
    assert set_bits == expected


def test_days_bitmaps_shuffle_numbers_only(spark):
    numbers = spark.range(70_000).select(F.concat(F.lit("d"), F.col("id") % 2).alias("day"), F.col("id").alias("number"))
    bits = m.day_bits(numbers.unionByName(numbers.limit(10)))
    assert _only_rows_are_shuffled(m.day_bits(numbers))
    counts = {(r.day, r.bucket): r.n for r in bits.select("day", "bucket", F.bitmap_count("bits").alias("n")).collect()}
    expected = numbers.groupBy("day", F.bitmap_bucket_number("number").alias("bucket")).count().collect()
    assert counts == {(r.day, r.bucket): r["count"] for r in expected}


def test_lines_are_made_from_written_facts(lake, spark, bronze_rows, monkeypatch):
    seen = []
    real = m.order_lines

    def order_lines(items, facts, products):
        seen.append(_plan(facts))
        return real(items, facts, products)

    monkeypatch.setattr(m, "order_lines", order_lines)
    from tidemark.plans import silver
    made = "2024-01-05 10:00:00"
    bronze = {
        "orders": bronze_rows("orders", {"order_id": "1", "customer_id": "c", "order_status": "shipped",
                                         "order_purchase_timestamp": made}),
        "order_items": bronze_rows("order_items", {"order_id": "1", "order_item_id": "1", "product_id": "p",
                                                   "price": "3.50", "freight_value": "1"}),
        "order_payments": bronze_rows("order_payments", {"order_id": "1", "payment_sequential": "1",
                                                         "payment_type": "boleto", "payment_value": "4.50"}),
        "customers": bronze_rows("customers", {"customer_id": "c", "customer_unique_id": "u"}),
        "products": bronze_rows("products", {"product_id": "p"}),
        "product_category_translation": bronze_rows("product_category_translation"),
    }
    for name in ("orders", "order_items", "order_payments"):
        bronze[f"live_{name}"] = bronze[name].limit(0)
    tables = {t: silver.SILVER[t](bronze) for t in (
        "stg_orders", "stg_order_items", "stg_order_payments", "stg_customers", "stg_products")}
    m.update_marts_from_silver(lake, tables, "run-1")
    assert "Join" not in seen[0]
    facts = gold.fct_orders(*(tables[t] for t in ("stg_orders", "stg_order_items", "stg_order_payments", "stg_customers")))
    got = [tuple(r) for r in m.daily_revenue(lake).select("order_date", "total_orders", "revenue").collect()]
    assert got == [tuple(r) for r in gold.mart_daily_revenue(facts).select("order_date", "total_orders", "revenue").collect()]


def test_items_are_summed_without_objects(spark):
    """Fact rows that repeat an order count as often as they are; what is collected is collected from facts, not items."""
    facts = spark.createDataFrame(
        [("1", "u", True, None), ("1", "v", False, None), ("1", "v", None, None), ("2", None, None, None), ("3", "w", True, None)],
        "order_id string, customer_unique_id string, is_valid_for_revenue boolean, order_date date")
    items = spark.createDataFrame(
        [("1", "p", 3, 1), ("1", "p", None, 1), ("1", "q", 5, None), ("2", None, 7, 1), (None, "p", 9, 1), ("4", "p", 9, 1)],
        "order_id string, product_id string, price int, freight_value int").select(
            "order_id", "product_id", F.col("price").cast("decimal(12,2)").alias("price"),
            F.col("freight_value").cast("decimal(12,2)").alias("freight_value"),
            (F.col("price") + F.col("freight_value")).cast("decimal(13,2)").alias("item_total"))
    products = spark.createDataFrame([("p", "a"), ("q", "b")], "product_id string, category string")
    lines = m.order_lines(items, facts, products)
    rows = {(r.order_id, r.category): (r.units, int(r.price), int(r.freight), int(r.total), r.priced, r.freighted, r.totalled,
                                       r.valid, sorted(r.persons)) for r in lines.collect()}
    assert rows == {
        ("1", "a"): (6, 9, 6, 12, 3, 6, 3, True, ["u", "v"]),
        ("1", "b"): (3, 15, 0, 0, 3, 0, 0, True, ["u", "v"]),
        ("2", "unknown"): (1, 7, 1, 8, 1, 1, 1, False, []),
    }
    objects = [x for x in _plan(lines).splitlines() if "ObjectHashAggregate" in x or "SortAggregate" in x]
    assert objects and not any("category" in x for x in objects)


def test_a_first_run_writes_its_rows_once(lake, spark, monkeypatch):
    """Facts, lines and counts that replace nothing are not copied beside themselves."""
    names, kept = [], m._Run.kept
    monkeypatch.setattr(m._Run, "kept", lambda self, name, df: names.append(name) or kept(self, name, df))
    facts = spark.createDataFrame(
        [("1", "u", None, 1, 1, 1, None, None, True)],
        "order_id string, customer_unique_id string, order_date date, order_total int, items_value int, freight_value int, "
        "delivered_to_customer_at timestamp_ntz, is_late_delivery boolean, is_valid_for_revenue boolean")
    lines = spark.createDataFrame(
        [("1", "a", 1, 1, 1, 2, 1, 1, 1, True, None, ["u"])],
        "order_id string, category string, units long, price int, freight int, total int, priced long, freighted long, "
        "totalled long, valid boolean, order_date date, persons array<string>")
    m.update_marts(lake, facts, lines, "r1")
    assert {"facts", "lines"} < set(names) and len(names) == len(set(names))
    assert not {"signed_facts", "signed_lines", "merged_day_people", "merged_category_people"} & set(names)
    names.clear()
    m.update_marts(lake, facts, lines, "r2", written=True)
    assert not {"facts", "lines"} & set(names) and "old_order_facts" in names
    assert [r.unique_customers for r in m.daily_revenue(lake).collect()] == [1]
