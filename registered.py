"""Every registered query, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import duckdb_sql as D
from tidemark import config as C
from tidemark.functions import utc_wall_clock
from tidemark.operators import history, quality
from tidemark.operators.joins import left_join_spread_nulls
from tidemark.operators.latest import latest_per_key
from tidemark.operators.sample import sample_rows
from tidemark.operators.upsert import in_parts, part_of, write_keyed
from tidemark.plans import checks, gold, incremental_marts, item_fact, profile, silver
from tidemark.session import prepare, scratch_dir
from tidemark.sources import csv_history, files, landing, testbed
from tidemark.sources.lake import Lake
from tidemark.streaming import live
from tidemark.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants as UTC wall clock, the shapes the oracle returns."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            c = utc_wall_clock(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(testbed.bronze(spark, sf_dir))


def written_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """For queries that read the same relations several times."""
    return Warehouse(testbed.bronze(spark, sf_dir), scratch_dir(spark, "warehouse"))


def gold_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """For queries that read gold relations only: silver holds the columns that those are made of."""
    return Warehouse(testbed.bronze(spark, sf_dir), scratch_dir(spark, "warehouse"), gold.SILVER_COLUMNS)


def checked_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """For the checks: silver holds the columns that they, the item fact and the gold relations are made of."""
    columns = {
        **gold.SILVER_COLUMNS, "stg_order_items": item_fact.COLUMNS,
        "stg_order_payments": (*gold.SILVER_COLUMNS["stg_order_payments"], "payment_sequential"),
    }
    return Warehouse(testbed.bronze(spark, sf_dir), scratch_dir(spark, "warehouse"), columns)


# --- silver relations -----------------------------------------------------------------------

_SILVER_MONEY = {
    "stg_order_items": "price freight_value item_total",
    "stg_order_payments": "payment_value",
}


def _silver(name: str) -> None:
    register(name, D.relation(name, _SILVER_MONEY.get(name, "")))(
        lambda spark, sf_dir: warehouse(spark, sf_dir).silver(name)
    )


for _name in (
    "stg_orders", "stg_order_items", "stg_order_payments",
    "stg_customers", "stg_products", "stg_sellers",
):
    _silver(_name)

# --- gold relations -------------------------------------------------------------------------

_GOLD_MONEY = {
    "fct_orders": "items_value freight_value order_total total_paid payment_gap",
    "dim_customers": "lifetime_value",
    "dim_products": "",
    "mart_daily_revenue": "revenue items_revenue freight_revenue",
    "mart_category_performance": "items_revenue freight_revenue total_revenue",
}


def _gold(name: str) -> None:
    register(name, D.relation(name, _GOLD_MONEY[name]))(
        lambda spark, sf_dir: getattr(warehouse(spark, sf_dir), name)
    )


for _name in _GOLD_MONEY:
    _gold(_name)


def all_tables(w: Warehouse) -> dict[str, DataFrame]:
    """The twelve relations the checks look at."""
    tables = {name: w.silver(name) for name in silver.SILVER}
    tables.update({name: getattr(w, name) for name in _GOLD_MONEY})
    tables["fct_order_items"] = item_fact.fact_rows(w.silver("stg_order_items"))
    return tables


# --- operators ------------------------------------------------------------------------------


@register("union_history_live", D.relation("b_orders", drop="k"))
def union_history_live(spark, sf_dir):
    b = testbed.bronze(spark, sf_dir)
    return silver.union_sources(b["orders"], b["live_orders"], C.ORDER_COLUMNS)


@register("dedupe_orders", D.sql("""
    SELECT order_id, arg_max(order_status, (ingested_at, source_file)) AS order_status,
           arg_max(source_system, (ingested_at, source_file)) AS source_system,
           max(ingested_at) AS ingested_at
    FROM clean_orders GROUP BY order_id"""))
def dedupe_orders(spark, sf_dir):
    b = testbed.bronze(spark, sf_dir)
    raw = silver.union_sources(b["orders"], b["live_orders"], C.ORDER_COLUMNS)
    copies = silver.clean_orders(raw).select(
        "order_id", "order_status", "source_system", "ingested_at", "source_file"
    )
    return latest_per_key(copies, C.ORDER_KEY).drop("source_file")


@register("dedupe_payments", D.sql("""
    SELECT order_id, payment_sequential::INT AS payment_sequential,
           arg_max(payment_value, (_ingested_at, _source_file))::DOUBLE AS payment_value,
           arg_max(source_system, (_ingested_at, _source_file)) AS source_system,
           count(*) AS copies
    FROM b_payments GROUP BY order_id, payment_sequential"""))
def dedupe_payments(spark, sf_dir):
    """Payments with the number of their copies: every fortieth order has two of each."""
    b = testbed.bronze(spark, sf_dir)
    raw = silver.union_sources(b["order_payments"], b["live_order_payments"], C.PAYMENT_COLUMNS)
    copies = silver.clean_order_payments(raw)
    counted = copies.groupBy(*C.PAYMENT_KEY).agg(F.count("*").alias("copies"))
    return latest_per_key(copies, C.PAYMENT_KEY).select(
        *C.PAYMENT_KEY, F.col("payment_value").cast("double").alias("payment_value"), "source_system"
    ).join(counted, list(C.PAYMENT_KEY))


@register("dedupe_items", D.sql("""
    SELECT order_id, order_item_id, arg_max(product_id, (_ingested_at, _source_file)) AS product_id,
           arg_max(price, (_ingested_at, _source_file)) AS price
    FROM b_items GROUP BY order_id, order_item_id"""))
def dedupe_items(spark, sf_dir):
    b = testbed.bronze(spark, sf_dir)
    copies = silver.union_sources(b["order_items"], b["live_order_items"], C.ITEM_COLUMNS).select(
        "order_id", "order_item_id", "product_id", "price", "_ingested_at", "_source_file"
    )
    newest = latest_per_key(copies, C.ITEM_KEY, ["_ingested_at", "_source_file"])
    return newest.drop("_ingested_at", "_source_file")


@register("orders_left_join_customers", D.sql("""
    SELECT o.order_id, o.customer_id, c.customer_unique_id, c.state, c.zip_code_prefix
    FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id"""))
def orders_left_join_customers(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    orders = w.silver("stg_orders").select("order_id", "customer_id")
    people = w.silver("stg_customers").select(
        "customer_id", "customer_unique_id", "state", "zip_code_prefix"
    )
    return left_join_spread_nulls(orders, people, "customer_id", "order_id")


register("items_per_order", D.relation("items_per_order", "items_value freight_value order_total"))(
    lambda spark, sf_dir: gold.items_per_order(warehouse(spark, sf_dir).silver("stg_order_items"))
)
register("payments_per_order", D.relation("payments_per_order", "total_paid"))(
    lambda spark, sf_dir: gold.payments_per_order(
        warehouse(spark, sf_dir).silver("stg_order_payments")
    )
)


@register("filtered_aggregates_daily", D.sql(f"""
    SELECT order_date, source_system, count(*) FILTER (is_valid_for_revenue) AS valid_orders,
           ifnull(sum(order_total) FILTER (is_valid_for_revenue), 0)::DOUBLE AS revenue,
           {D.half_up("10000 * count(*) FILTER (is_late_delivery)",
                      "count(delivered_to_customer_at)")} AS late_delivery_pct
    FROM fct_orders GROUP BY ALL"""))
def filtered_aggregates_daily(spark, sf_dir):
    valid = F.col("is_valid_for_revenue")
    late = 100 * F.count_if("is_late_delivery")
    return warehouse(spark, sf_dir).fct_orders.groupBy("order_date", "source_system").agg(
        F.count_if(valid).alias("valid_orders"),
        F.coalesce(F.sum(F.when(valid, F.col("order_total"))), F.lit(0)).alias("revenue"),
        gold.ratio(late, F.count("delivered_to_customer_at")).alias("late_delivery_pct"),
    )


@register("distinct_filtered_customers", D.sql("""
    SELECT customer_state, count(DISTINCT customer_unique_id) AS persons,
           count(DISTINCT customer_unique_id) FILTER (is_valid_for_revenue) AS paying_persons
    FROM fct_orders GROUP BY ALL"""))
def distinct_filtered_customers(spark, sf_dir):
    paying = F.when(F.col("is_valid_for_revenue"), F.col("customer_unique_id"))
    return warehouse(spark, sf_dir).fct_orders.groupBy("customer_state").agg(
        F.count_distinct("customer_unique_id").alias("persons"),
        F.count_distinct(paying).alias("paying_persons"),
    )


@register("category_share_and_rank", D.sql(f"""
    SELECT state, sum(lifetime_value)::DOUBLE AS revenue,
           {D.half_up("sum(lifetime_value) * 1000000",
                      "sum(sum(lifetime_value)) OVER () * 100")} AS share_pct,
           rank() OVER (ORDER BY sum(lifetime_value) DESC NULLS FIRST) AS revenue_rank
    FROM dim_customers GROUP BY state"""))
def category_share_and_rank(spark, sf_dir):
    per_state = warehouse(spark, sf_dir).dim_customers.groupBy("state").agg(
        F.sum("lifetime_value").alias("revenue")
    )
    return gold.with_share_and_rank(per_state, "revenue", "share_pct", "revenue_rank")


@register("latest_location", D.relation("latest_location"))
def latest_location(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return gold.latest_location(w.fct_orders, w.silver("stg_customers"))


@register("delivery_metrics", D.sql("""
    SELECT order_id, delivery_days, is_late_delivery, payment_gap::DOUBLE AS payment_gap
    FROM fct_orders WHERE delivered_to_customer_at IS NOT NULL"""))
def delivery_metrics(spark, sf_dir):
    return warehouse(spark, sf_dir).fct_orders.where("delivered_to_customer_at IS NOT NULL").select(
        "order_id", "delivery_days", "is_late_delivery", "payment_gap"
    )


@register("value_segments", D.sql("""
    SELECT value_segment, is_repeat_customer, count(*) AS persons,
           sum(lifetime_value)::DOUBLE AS lifetime_value
    FROM dim_customers GROUP BY ALL"""))
def value_segments(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_customers.groupBy(
        "value_segment", "is_repeat_customer"
    ).agg(F.count("*").alias("persons"), F.sum("lifetime_value").alias("lifetime_value"))


@register("size_bands", D.sql("""
    SELECT size_band, count(*) AS products, min(volume_cm3) AS smallest_cm3,
           max(volume_cm3) AS largest_cm3
    FROM dim_products GROUP BY ALL"""))
def size_bands(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_products.groupBy("size_band").agg(
        F.count("*").alias("products"),
        F.min("volume_cm3").alias("smallest_cm3"),
        F.max("volume_cm3").alias("largest_cm3"),
    )


# --- increment, upsert, history -------------------------------------------------------------

_MARK = "2024-01-03 12:00:00"
_FACT_COLUMNS = ", ".join(
    f"{c}::DOUBLE AS {c}" if c in ("price", "freight_value", "item_total") else c
    for c in item_fact.COLUMNS
)


@register("increment_after_watermark", D.sql(f"""
    SELECT {_FACT_COLUMNS} FROM stg_order_items
    WHERE ingested_at > TIMESTAMP '{_MARK}' - INTERVAL 1 HOUR"""))
def increment_after_watermark(spark, sf_dir):
    b = testbed.bronze(spark, sf_dir)
    mark = F.lit(f"{_MARK}+00:00").cast("timestamp")
    rows = item_fact.increment(b["order_items"], b["live_order_items"], mark)
    return rows.select(*item_fact.COLUMNS)


@register("upsert_delete_insert", D.sql(f"SELECT {_FACT_COLUMNS} FROM stg_order_items"))
def upsert_delete_insert(spark, sf_dir):
    """Two runs of the incremental fact: what had arrived by noon, then everything."""
    b = testbed.bronze(spark, sf_dir)
    lake = Lake(spark, scratch_dir(spark, "upsert"))
    by_noon = b["live_order_items"].where(
        F.col("_ingested_at").cast("timestamp") <= F.lit(f"{_MARK}+00:00").cast("timestamp")
    )
    item_fact.update_item_fact(lake, b["order_items"], by_noon, "run-1", buckets=4)
    item_fact.update_item_fact(lake, b["order_items"], b["live_order_items"], "run-2", buckets=4)
    return lake.read("gold", "fct_order_items").select(*item_fact.COLUMNS)


_INSIDE, _OUTSIDE = "2024-01-03T11:30:00+00:00", "2024-01-03T10:30:00+00:00"
_LATE = f"left(_ingested_at, 19)::TIMESTAMP > TIMESTAMP '{_MARK}'"
_WINNER = """QUALIFY row_number() OVER (
        PARTITION BY order_id, order_item_id ORDER BY _ingested_at DESC, _source_file DESC) = 1"""


@register("increment_late_rows", D.sql(f"""
    SELECT * FROM (WITH copies AS (
      SELECT order_id, order_item_id::INT AS order_item_id, product_id, price::DOUBLE AS price,
             {_LATE} AS late, _source_file,
             CASE WHEN NOT {_LATE} THEN _ingested_at WHEN product_id::INT % 2 = 0 THEN '{_INSIDE}'
                  ELSE '{_OUTSIDE}' END AS _ingested_at
      FROM b_items
    ), first_run AS (SELECT * FROM copies WHERE NOT late {_WINNER}
    ), taken AS (
      SELECT * FROM (SELECT * FROM copies {_WINNER})
      WHERE left(_ingested_at, 19)::TIMESTAMP > TIMESTAMP '{_MARK}' - INTERVAL 1 HOUR
    )
    SELECT order_id, order_item_id, product_id, price, _ingested_at AS loaded FROM taken
    UNION ALL
    SELECT order_id, order_item_id, product_id, price, _ingested_at FROM first_run f
    WHERE NOT EXISTS (SELECT 1 FROM taken t
                      WHERE t.order_id = f.order_id AND t.order_item_id = f.order_item_id))"""))
def increment_late_rows(spark, sf_dir):
    """What came after noon arrives with older load times: half of it inside the lookback, half
    outside. The former is taken and replaces returning keys, the latter is not seen."""
    b = testbed.bronze(spark, sf_dir)
    lake = Lake(spark, scratch_dir(spark, "late"))
    time = F.col("_ingested_at").cast("timestamp")
    noon = F.lit(f"{_MARK}+00:00").cast("timestamp")
    live = b["live_order_items"]
    shifted = F.when(time <= noon, F.col("_ingested_at")).otherwise(
        F.when(F.col("product_id").cast("int") % 2 == 0, _INSIDE).otherwise(_OUTSIDE)
    )
    item_fact.update_item_fact(lake, b["order_items"], live.where(time <= noon), "run-1", buckets=4)
    item_fact.update_item_fact(
        lake, b["order_items"], live.withColumn("_ingested_at", shifted), "run-2", buckets=4
    )
    loaded = F.concat(F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return lake.read("gold", "fct_order_items").select(
        "order_id", "order_item_id", "product_id", F.col("price").cast("double").alias("price"),
        loaded.alias("loaded"),
    )


@register("landing_changed_files", D.sql("""
    SELECT 'orders/orders_late_' || lpad((k % 3)::VARCHAR, 5, '0') || '.jsonl' AS source_file,
           count(*) AS row_count, k % 3 = 1 AS changed
    FROM b_orders WHERE source_system = 'live' GROUP BY ALL"""))
def landing_changed_files(spark, sf_dir):
    """Live orders in three files; one is written anew with its lines in another order, and the
    comparison by content finds it. The log keeps the rows of the first load."""
    root = scratch_dir(spark, "changed")
    k = F.col("order_id").cast("long") % 3
    rows = testbed.bronze(spark, sf_dir)["live_orders"].select(*C.ORDER_COLUMNS)

    def put(n: int, order) -> None:
        landing.export_landing(
            rows.where(k == n).repartition(1).sortWithinPartitions(order), f"{root}/landing", "orders", f"late{n}")

    lake = Lake(spark, f"{root}/lake")
    for n in range(3):
        put(n, F.col("order_id"))
    landing.ingest_landing(lake, f"{root}/landing", "load-1")
    files.delete(spark, f"{root}/landing/orders/orders_late1_00000.jsonl")
    put(1, F.desc("order_id"))
    listing = landing.list_landing(spark, f"{root}/landing", "orders")
    now = landing.fingerprints(spark, listing, "orders").withColumnRenamed("file_sha256", "now")
    return landing.ingestion_log(lake).join(now, "source_file").select(
        F.regexp_replace("source_file", "late(.)_00000", "late_0000$1").alias("source_file"),
        F.col("row_count").cast("long").alias("row_count"), (F.col("now") != F.col("file_sha256")).alias("changed"),
    )


register("fct_order_items", D.sql(f"SELECT {_FACT_COLUMNS} FROM stg_order_items"))(
    lambda spark, sf_dir: item_fact.fact_rows(
        warehouse(spark, sf_dir).silver("stg_order_items")
    ).drop("processed_at")
)

_SNAPSHOT_TIMES = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")
CHECKED = ("zip_code_prefix", "city", "state")


def _customer_states(customers: DataFrame) -> list[DataFrame]:
    """Three states of the customer list: N5 joins at the second; there N1 and N2 move, N3
    loses its zip and N7 is missing; the third is the list as it is."""
    state = F.col("state")
    second = customers.where(state != "N7").withColumns({
        "city": F.when(state.isin("N1", "N2"), F.upper("city")).otherwise(F.col("city")),
        "zip_code_prefix": F.when(state != "N3", F.col("zip_code_prefix")),
    })
    return [customers.where(state != "N5"), second, customers]


def _scd_rows(start: int, end: str, where: str, replace: str = "") -> str:
    t = f"TIMESTAMP '{_SNAPSHOT_TIMES[start]}'"
    return f"""
    SELECT * {f"REPLACE ({replace})" if replace else ""},
           md5(customer_id || '|{_SNAPSHOT_TIMES[start]}') AS scd_id, {t} AS updated_at,
           {t} AS valid_from, {end} AS valid_to
    FROM stg_customers WHERE {where}"""


_T2, _T3 = (f"TIMESTAMP '{t}'" for t in _SNAPSHOT_TIMES[1:])
_SCD_ORACLE = "UNION ALL".join((
    _scd_rows(0, f"CASE WHEN state IN ('N1', 'N2', 'N3') THEN {_T2} END", "state <> 'N5'"),
    _scd_rows(1, "NULL", "state = 'N5'"),
    _scd_rows(1, _T3, "state IN ('N1', 'N2')", "upper(city) AS city"),
    _scd_rows(1, _T3, "state = 'N3'", "NULL AS zip_code_prefix"),
    _scd_rows(2, "NULL", "state IN ('N1', 'N2', 'N3')"),
))


def _moment(text: str):
    return F.lit(f"{text}+00:00").cast("timestamp")


@register("scd2_after_three_runs", D.sql(_SCD_ORACLE))
def scd2_after_three_runs(spark, sf_dir):
    lake = Lake(spark, scratch_dir(spark, "history"))
    customers = warehouse(spark, sf_dir).silver("stg_customers")
    for n, (state, time) in enumerate(zip(_customer_states(customers), _SNAPSHOT_TIMES)):
        history.update_history(
            lake, "snap_customers", state, "customer_id", CHECKED, _moment(time), f"run-{n}"
        )
    return history.read_history(lake, "snap_customers")


@register("history_valid_at", D.sql(f"""
    SELECT customer_id, city, state, zip_code_prefix, valid_from FROM ({_SCD_ORACLE})
    WHERE valid_from <= TIMESTAMP '2024-02-15'
      AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-02-15')"""))
def history_valid_at(spark, sf_dir):
    versions = None
    customers = warehouse(spark, sf_dir).silver("stg_customers")
    for state, time in zip(_customer_states(customers), _SNAPSHOT_TIMES):
        versions = history.snapshot_check(versions, state, "customer_id", CHECKED, _moment(time))
    return history.valid_at(versions, _moment("2024-02-15 00:00:00")).select(
        "customer_id", "city", "state", "zip_code_prefix", "valid_from"
    )


# --- marts by deltas, returning keys, as-of reads -------------------------------------------

_RUNS = (_MARK, None)
_MART_SOURCES = ("stg_orders", "stg_order_items", "stg_order_payments", "stg_customers", "stg_products")


_mart_lakes: dict[tuple[str, str], Lake] = {}


def marts_by_deltas(spark: SparkSession, sf_dir: str) -> Lake:
    """What had arrived by noon, then everything. Late orders fall on days of all years, and redelivered
    ones change their state, so contributions are taken back. The queries of a session read one lake."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _mart_lakes:
        return _mart_lakes[known]
    root = scratch_dir(spark, "marts")
    lake = Lake(spark, f"{root}/lake")
    b = testbed.bronze(spark, sf_dir)
    lists = {}  # customers and products, the same in both runs
    for n, until in enumerate(_RUNS):
        arrived = dict(b)
        if until is not None:
            for name in C.LANDING_TABLES.values():
                arrived[name] = b[name].where(F.col("_ingested_at").cast("timestamp") <= _moment(until))
        w = Warehouse(arrived, f"{root}/silver-{n}", incremental_marts.SILVER_COLUMNS)
        lists = lists or {t: w.silver(t) for t in ("stg_customers", "stg_products")}
        tables = {t: lists[t] if t in lists else w.silver(t) for t in _MART_SOURCES}
        incremental_marts.update_marts_from_silver(lake, tables, f"run-{n}", span="year")
    _mart_lakes[known] = lake
    return lake


@register("daily_revenue_by_deltas", D.relation("mart_daily_revenue", _GOLD_MONEY["mart_daily_revenue"]))
def daily_revenue_by_deltas(spark, sf_dir):
    return incremental_marts.daily_revenue(marts_by_deltas(spark, sf_dir))


@register("category_performance_by_deltas",
          D.relation("mart_category_performance", _GOLD_MONEY["mart_category_performance"]))
def category_performance_by_deltas(spark, sf_dir):
    return incremental_marts.category_performance(marts_by_deltas(spark, sf_dir))


@register("customers_from_bitmaps", D.sql("""
    SELECT 'day' AS span, order_date AS begins, count(DISTINCT customer_unique_id) AS customers FROM fct_orders
    WHERE is_valid_for_revenue AND customer_unique_id IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT 'month', date_trunc('month', order_date)::DATE, count(DISTINCT customer_unique_id) FROM fct_orders
    WHERE is_valid_for_revenue AND customer_unique_id IS NOT NULL GROUP BY ALL"""))
def customers_from_bitmaps(spark, sf_dir):
    """Distinct paying customers of each day and month, from the stored bitmaps of the days."""
    lake = marts_by_deltas(spark, sf_dir)
    day = incremental_marts.customers_by(lake, lambda d: d, "begins")
    month = incremental_marts.customers_by(lake, lambda d: F.trunc(d, "month"), "begins")
    return day.select(F.lit("day").alias("span"), "begins", "customers").unionByName(
        month.select(F.lit("month").alias("span"), "begins", "customers"))


@register("upsert_returning_keys", D.sql("""
    SELECT order_id, order_item_id, (CASE WHEN order_id::BIGINT % 97 = 0 THEN -price ELSE price END)::DOUBLE AS price,
           'day ' || CASE WHEN order_id::BIGINT % 97 = 0 THEN 30 ELSE (order_id::BIGINT // 4) % 30 END AS loaded
    FROM stg_order_items"""))
def upsert_returning_keys(spark, sf_dir):
    """Items loaded on thirty days; on the next one, every 97th order comes back with another price. Its old rows
    are found by key filters and deleted, whatever day they were loaded on."""
    lake = Lake(spark, scratch_dir(spark, "returning"))
    number = F.col("order_id").cast("long")
    read = {"stg_order_items": ("order_id", "order_item_id", "price")}
    silver_items = Warehouse(testbed.bronze(spark, sf_dir), scratch_dir(spark, "warehouse"), read)
    items = silver_items.silver("stg_order_items").select(
        "order_id", "order_item_id", F.col("price").cast("double").alias("price"),
        F.floor(number / 4 % 30).cast("int").alias("n"))

    def on(day, rows):
        at = _moment("2024-01-01 00:00:00") + F.make_dt_interval(days=day)
        return rows.withColumn("loaded", at)

    write_keyed(lake, "gold", "items", on(F.col("n"), items).drop("n"), C.ITEM_KEY, "run-1", 2, period="loaded")
    back = items.where(number % 97 == 0).withColumn("price", -F.col("price"))
    write_keyed(lake, "gold", "items", on(F.lit(30), back).drop("n"), C.ITEM_KEY, "run-2", 2, period="loaded")
    day = F.datediff("loaded", _moment("2024-01-01 00:00:00"))
    return lake.read("gold", "items").withColumn("loaded", F.concat(F.lit("day "), day))


_ORDER_MOMENT = "TIMESTAMP '2023-12-15' + to_days((epoch_us(purchased_at) // 86400000000 % 120)::INT)"


@register("location_at_order_time", D.sql(f"""
    SELECT o.order_id, o.customer_id, h.city, h.state, h.zip_code_prefix
    FROM (SELECT *, {_ORDER_MOMENT} AS at FROM stg_orders) o
    LEFT JOIN ({_SCD_ORACLE}) h ON o.customer_id = h.customer_id AND h.valid_from <= o.at
          AND (h.valid_to IS NULL OR h.valid_to > o.at)"""))
def location_at_order_time(spark, sf_dir):
    """Where each order's customer lived at the time of the order: days of purchase, folded into the
    four months in which the customer list changed three times."""
    w = written_warehouse(spark, sf_dir)
    customers = w.silver("stg_customers")
    versions = None
    for state, time in zip(_customer_states(customers), _SNAPSHOT_TIMES):
        versions = history.snapshot_check(versions, state, "customer_id", CHECKED, _moment(time))
    day = F.floor(F.unix_micros(F.col("purchased_at").cast("timestamp")) / F.lit(86400000000)) % 120
    at = _moment("2023-12-15 00:00:00") + F.make_dt_interval(days=day.cast("int"))
    orders = w.silver("stg_orders").select("order_id", "customer_id", at.alias("at"))
    return history.as_of_join(orders, versions, "customer_id", "at", ["city", "state", "zip_code_prefix"]).drop("at")


# --- loading --------------------------------------------------------------------------------

_RAW_ORDERS = ", ".join(f"nullif({c}, '') AS {c}" for c in C.ORDER_COLUMNS)


@register("csv_full_refresh", D.sql(f"""
    SELECT {_RAW_ORDERS}, _source_file FROM (
      SELECT * REPLACE ('olist_orders_dataset.csv' AS _source_file) FROM b_orders
      WHERE source_system = 'olist')"""))
def csv_full_refresh(spark, sf_dir):
    """The history orders written as CSV, loaded twice by the full-refresh loader."""
    root = scratch_dir(spark, "csv")
    rows = testbed.bronze(spark, sf_dir)["orders"].select(*C.ORDER_COLUMNS)
    file_name = "olist_orders_dataset.csv"
    rows.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{root}/raw/{file_name}")
    lake = Lake(spark, f"{root}/lake")
    for batch_id in ("load-1", "load-2"):
        csv_history.load_history(lake, f"{root}/raw", batch_id, {file_name: "orders"})
    return lake.read("bronze", "orders").select(*C.ORDER_COLUMNS, "_source_file")


@register("landing_exactly_once", D.sql(f"""
    SELECT {_RAW_ORDERS}, 1 AS copies FROM b_orders WHERE source_system = 'live'"""))
def landing_exactly_once(spark, sf_dir):
    """The live orders exported as JSON Lines, loaded, and offered to the loader again."""
    root = scratch_dir(spark, "landing")
    rows = testbed.bronze(spark, sf_dir)["live_orders"].select(*C.ORDER_COLUMNS)
    landing.export_landing(rows, f"{root}/landing", "orders", "a")
    lake = Lake(spark, f"{root}/lake")
    for batch_id in ("load-1", "load-2"):
        landing.ingest_landing(lake, f"{root}/landing", batch_id)
    return (
        landing.live_table(lake, "orders")
        .groupBy(*C.ORDER_COLUMNS)
        .agg(F.count("*").cast("int").alias("copies"))
    )


@register("ingest_classify_files", D.sql("""
    SELECT _source_file AS source_file, count(*) AS file_length,
           CASE WHEN any_value(_ingested_at) >= '2024-01-04' THEN 'new'
                WHEN any_value(_ingested_at) >= '2024-01-03' THEN 'check' ELSE 'known' END AS status
    FROM b_orders WHERE source_system = 'live' GROUP BY ALL"""))
def ingest_classify_files(spark, sf_dir):
    """Live order files against a log that ends with the second day, when files were still
    being completed."""
    listed = (
        testbed.bronze(spark, sf_dir)["live_orders"]
        .groupBy(F.col("_source_file").alias("source_file"))
        .agg(
            F.count("*").alias("file_length"),
            F.max(F.col("_ingested_at").cast("timestamp")).alias("modified_at"),
        )
        .withColumn("path", F.col("source_file"))
    )
    day_two, day_three = _moment("2024-01-03 00:00:00"), _moment("2024-01-04 00:00:00")
    log = listed.where(F.col("modified_at") < day_three).select(
        "source_file",
        F.lit("0" * 64).alias("file_sha256"),
        (F.col("file_length") - (F.col("modified_at") >= day_two).cast("int")).alias("file_length"),
        "modified_at",
    )
    return landing.classify(listed, log, rehash_known=False).select("source_file", "file_length", "status")


@register("stream_landing_to_silver", D.relation("stg_orders", drop="ingested_at source_file batch_id"))
def stream_landing_to_silver(spark, sf_dir):
    """Live orders arrive as files in two goes; a stream loads them and upserts silver over
    the history."""
    root = scratch_dir(spark, "stream")
    b = testbed.bronze(spark, sf_dir)
    lake = Lake(spark, f"{root}/lake")
    lake.replace("bronze", "orders", b["orders"], "history")
    arrivals = b["live_orders"]
    noon = F.col("_ingested_at").cast("timestamp") <= _moment(_MARK)
    for tag, rows in (("a", arrivals.where(noon)), ("b", arrivals.where(~noon))):
        landing.export_landing(rows.select(*C.ORDER_COLUMNS), f"{root}/landing", "orders", tag)
        live.stream_landing(
            lake, f"{root}/landing", "orders", f"{root}/checkpoint", upsert_buckets=4
        ).awaitTermination()
    return lake.read("silver", live.current_table("orders")).drop(
        "ingested_at", "source_file", "batch_id"
    )


def _raw_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine files of the history by bronze table; reviews have line breaks and quotes in their cells."""
    b = testbed.bronze(spark, sf_dir)
    tables = {name: b[name].select(*C.BRONZE_COLUMNS[name]) for name in C.HISTORY_FILES.values() if name in b}
    tables["geolocation"] = b["customers"].select(
        F.col("customer_zip_code_prefix").alias("geolocation_zip_code_prefix"),
        F.lit("-1.5").alias("geolocation_lat"), F.lit("2.25").alias("geolocation_lng"),
        F.col("customer_city").alias("geolocation_city"), F.col("customer_state").alias("geolocation_state"))
    tables["order_reviews"] = b["orders"].select(
        F.concat(F.lit("r"), F.col("order_id")).alias("review_id"), "order_id",
        F.concat(F.lit('said "'), F.col("order_status"), F.lit('",\nthen\n'), F.col("order_id")).alias("review_comment_message"))
    return tables


_NINE_FILES = {
    "customers": "SELECT * FROM b_customers",
    "geolocation": "SELECT customer_zip_code_prefix, '-1.5', '2.25', customer_city, customer_state FROM b_customers",
    "orders": f"SELECT {', '.join(C.ORDER_COLUMNS)} FROM b_orders WHERE source_system = 'olist'",
    "order_items": f"SELECT {', '.join(C.ITEM_COLUMNS)} FROM b_items WHERE source_system = 'olist'",
    "order_payments": f"SELECT {', '.join(C.PAYMENT_COLUMNS)} FROM b_payments WHERE source_system = 'olist'",
    "order_reviews": """SELECT 'r' || order_id, order_id, 'said "' || order_status || '",' || chr(10) || 'then' || chr(10)
                        || order_id FROM b_orders WHERE source_system = 'olist'""",
    "products": "SELECT * FROM b_products",
    "sellers": """SELECT s_suppkey::VARCHAR, (s_suppkey * 37)::VARCHAR, '  porto/' || lower(n_name) || ' ', ' n' || s_nationkey
                  FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "product_category_translation": "SELECT * FROM b_translation",
}


@register("csv_nine_files", D.sql(" UNION ALL ".join(f"""
    SELECT '{table}' AS table_name, '{name}' AS source_file, count(*) AS row_count,
           ifnull(sum(length(cells)), 0)::BIGINT AS chars,
           ifnull(sum(length(cells) - length(replace(cells, chr(10), ''))), 0)::BIGINT AS line_breaks
    FROM (SELECT concat_ws('', *COLUMNS(*)) AS cells FROM ({_NINE_FILES[table]}))"""
    for name, table in C.HISTORY_FILES.items())))
def csv_nine_files(spark, sf_dir):
    """The whole history, nine files, through the full-refresh loader; every cell of every stored row is counted."""
    root = scratch_dir(spark, "nine")
    for name, table in C.HISTORY_FILES.items():
        _raw_files(spark, sf_dir)[table].write.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(f"{root}/raw/{name}")
    lake = Lake(spark, f"{root}/lake")
    loaded = csv_history.load_history(lake, f"{root}/raw", "load-1")
    stored = None
    for table in C.HISTORY_FILES.values():
        rows = lake.read("bronze", table)
        cells = F.concat_ws("", *[c for c in rows.columns if c not in C.LINEAGE])
        counted = rows.agg(
            F.lit(table).alias("table_name"), F.coalesce(F.sum(F.char_length(cells)), F.lit(0)).alias("chars"),
            F.coalesce(F.sum(F.regexp_count(cells, F.lit("\n"))), F.lit(0)).cast("long").alias("line_breaks"))
        stored = counted if stored is None else stored.unionByName(counted)
    return loaded.join(stored, "table_name")


_LIVE = {"orders": ("b_orders", C.ORDER_COLUMNS), "order_items": ("b_items", C.ITEM_COLUMNS),
         "order_payments": ("b_payments", C.PAYMENT_COLUMNS)}


@register("landing_three_entities", D.sql(" UNION ALL ".join(f"""
    SELECT '{entity}' AS entity, run, status, CASE WHEN run = 'load-1' AND status = 'new' THEN n ELSE 0 END AS rows,
           CASE WHEN run = 'load-1' THEN n END AS logged, CASE WHEN run = 'load-1' THEN chars END AS chars
    FROM (SELECT count(*) AS n, sum(length(concat_ws('', {', '.join(columns)})))::BIGINT AS chars FROM {table}
          WHERE source_system = 'live'),
         (VALUES ('load-1', 'new'), ('load-2', 'skipped')) AS runs(run, status)"""
    for entity, (table, columns) in _LIVE.items())))
def landing_three_entities(spark, sf_dir):
    """Orders, items and payments through the landing zone, twice: the run summaries, the rows that the log gives for
    the files of each entity, and all cells of the live tables."""
    root = scratch_dir(spark, "entities")
    b = testbed.bronze(spark, sf_dir)
    for entity, table in C.LANDING_TABLES.items():
        landing.export_landing(b[table].select(*_LIVE[entity][1]).repartition(3), f"{root}/landing", entity, "a")
    lake = Lake(spark, f"{root}/lake")
    summary = None
    for run in ("load-1", "load-2"):
        got = landing.ingest_landing(lake, f"{root}/landing", run).withColumn("run", F.lit(run))
        summary = got if summary is None else summary.unionByName(got)
    logged = landing.ingestion_log(lake).groupBy("entity", F.col("batch_id").alias("run")).agg(
        F.sum("row_count").cast("long").alias("logged"))
    cells = None
    for entity in C.LANDING_TABLES:
        columns = _LIVE[entity][1]
        one = landing.live_table(lake, entity).groupBy(F.col("_batch_id").alias("run")).agg(
            F.lit(entity).alias("entity"), F.sum(F.char_length(F.concat_ws("", *columns))).alias("chars"))
        cells = one if cells is None else cells.unionByName(one)
    return (
        summary.where("files > 0").join(logged, ["entity", "run"], "left").join(cells, ["entity", "run"], "left")
        .select("entity", "run", "status", "rows", "logged", "chars")
    )


@register("landing_files_by_status", D.sql("""
    SELECT 'orders/orders_part' || k // 10 % 4 AS source_file, count(*) AS lines,
           CASE WHEN k // 10 % 4 >= 2 THEN 'new' WHEN k // 10 % 4 = 1 THEN 'changed' ELSE 'known' END AS status
    FROM b_orders WHERE source_system = 'live' GROUP BY ALL"""))
def landing_files_by_status(spark, sf_dir):
    """Real files listed and hashed with the default setting: two are in the log, one of them was written anew in
    another order since, two are new."""
    root = scratch_dir(spark, "status")
    rows = testbed.bronze(spark, sf_dir)["live_orders"].select(*C.ORDER_COLUMNS)
    n = F.floor(F.col("order_id").cast("long") / 10) % 4

    def put(part: int, order) -> None:
        landing.export_landing(
            rows.where(n == part).repartition(1).sortWithinPartitions(order), f"{root}/landing", "orders", f"part{part}")

    put(0, "order_id")
    put(1, "order_id")
    lake = Lake(spark, f"{root}/lake")
    landing.ingest_landing(lake, f"{root}/landing", "load-1")
    files.delete(spark, f"{root}/landing/orders/orders_part1_00000.jsonl")
    for part in (1, 2, 3):
        put(part, F.desc("order_id"))
    listing = landing.list_landing(spark, f"{root}/landing", "orders")
    states = landing.classify(listing, landing.ingestion_log(lake))
    now = landing.fingerprints(spark, listing, "orders")
    lines = landing.read_lines(spark, [f"{root}/landing/orders"]).groupBy(
        F.concat(F.lit("orders/"), F.col("file_name")).alias("source_file")).agg(F.count(F.lit(1)).alias("lines"))
    differs = F.col("file_sha256") != F.col("logged_sha256")
    status = F.when(F.col("status") == "new", "new").when(differs, "changed").otherwise("known")
    return states.join(now, "source_file").join(lines, "source_file").select(
        F.regexp_replace("source_file", r"_\d+\.jsonl$", "").alias("source_file"), "lines", status.alias("status"))


# --- profiles and samples -------------------------------------------------------------------


@register("defect_profile", D.sql(f"""
    SELECT 'duplicate_order' AS issue, count(*) - count(DISTINCT order_id) AS row_count FROM b_orders
    UNION ALL SELECT 'missing_customer', count(*) FROM b_orders WHERE coalesce(trim(customer_id), '') = ''
    UNION ALL SELECT 'messy_status', count(*) FROM b_orders WHERE order_status <> lower(trim(order_status))
    UNION ALL SELECT 'iso_timestamp', count(*) FROM b_orders WHERE order_purchase_timestamp LIKE '%T%'
    UNION ALL SELECT 'negative_price', count(*) FROM b_items WHERE price LIKE '-%' AND price::DOUBLE < 0
    UNION ALL SELECT 'unknown_payment_type', count(*) FROM b_payments
              WHERE lower(trim(payment_type)) NOT IN {D.ACCEPTED}"""))
def defect_profile(spark, sf_dir):
    b = testbed.bronze(spark, sf_dir)
    return profile.defect_profile(
        b["orders"].unionByName(b["live_orders"]),
        b["order_items"].unionByName(b["live_order_items"]),
        b["order_payments"].unionByName(b["live_order_payments"]),
    )


_AVG_PRICE = D.half_up("sum(price::DECIMAL(18,4)) * 1000000", "count(price)", 1000000)
_PAIRS = f"""
    SELECT product_id, seller_id, {_AVG_PRICE} AS avg_price FROM b_items
    WHERE source_system = 'olist' GROUP BY product_id, seller_id"""


@register("product_seller_avg_price", D.sql(_PAIRS))
def product_seller_avg_price(spark, sf_dir):
    return profile.product_seller_avg_price(testbed.bronze(spark, sf_dir)["order_items"])


@register("sample_product_sellers", D.sql(f"""
    SELECT * FROM ({_PAIRS}) ORDER BY md5('7:' || product_id || ':' || seller_id), product_id, seller_id
    LIMIT 500"""))
def sample_product_sellers(spark, sf_dir):
    pairs = profile.product_seller_avg_price(testbed.bronze(spark, sf_dir)["order_items"])
    return sample_rows(pairs, ["product_id", "seller_id"], 500, seed=7)


@register("sample_customers", D.sql("""
    SELECT customer_id FROM b_customers ORDER BY md5('7:' || customer_id), customer_id LIMIT 500"""))
def sample_customers(spark, sf_dir):
    ids = testbed.bronze(spark, sf_dir)["customers"].select("customer_id")
    return sample_rows(ids, ["customer_id"], 500, seed=7)


# --- data quality ---------------------------------------------------------------------------
# Each check runs where the test bed has defects, so that failing rows are compared.


@register("dq_unique", D.sql("""
    SELECT customer_unique_id AS unique_field, count(*) AS n_records FROM stg_customers
    WHERE customer_unique_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1"""))
def dq_unique(spark, sf_dir):
    return quality.unique(warehouse(spark, sf_dir).silver("stg_customers"), "customer_unique_id")


@register("dq_not_null", D.sql("SELECT * FROM stg_orders WHERE customer_id IS NULL"))
def dq_not_null(spark, sf_dir):
    return quality.not_null(warehouse(spark, sf_dir).silver("stg_orders"), "customer_id")


@register("dq_relationships", D.sql("""
    SELECT category_name_pt AS from_field, count(*) AS n_records FROM stg_products
    WHERE category_name_pt IS NOT NULL AND category_name_pt NOT IN (SELECT pt FROM b_translation)
    GROUP BY ALL"""))
def dq_relationships(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return quality.relationships(
        w.silver("stg_products"), "category_name_pt",
        w.bronze["product_category_translation"], "product_category_name",
    )


@register("dq_accepted_values", D.sql(f"""
    SELECT order_status AS value_field, count(*) AS n_records FROM b_orders
    WHERE order_status NOT IN {D.STATUSES} GROUP BY ALL"""))
def dq_accepted_values(spark, sf_dir):
    b = testbed.bronze(spark, sf_dir)
    raw = silver.union_sources(b["orders"], b["live_orders"], C.ORDER_COLUMNS)
    return quality.accepted_values(raw, "order_status", C.ORDER_STATUSES)


@register("dq_not_flagged", D.sql("""
    SELECT * REPLACE (price::DOUBLE AS price, freight_value::DOUBLE AS freight_value,
                      item_total::DOUBLE AS item_total)
    FROM stg_order_items WHERE is_negative_price"""))
def dq_not_flagged(spark, sf_dir):
    return quality.not_flagged(warehouse(spark, sf_dir).silver("stg_order_items"), "is_negative_price")


@register("dq_unique_combination", D.sql("""
    SELECT order_id, order_item_id, count(*) AS duplicate_count FROM b_items
    GROUP BY ALL HAVING count(*) > 1"""))
def dq_unique_combination(spark, sf_dir):
    b = testbed.bronze(spark, sf_dir)
    raw = silver.union_sources(b["order_items"], b["live_order_items"], C.ITEM_COLUMNS)
    return quality.unique_combination(raw, C.ITEM_KEY)


@register("dq_unique_since_load", D.sql("""
    SELECT order_id, order_item_id, 2 AS duplicate_count FROM stg_order_items WHERE order_id::BIGINT % 97 = 0"""))
def dq_unique_since_load(spark, sf_dir):
    """Items of thirty load days; the next load appends every 97th order again. Only its own keys, and the old parts
    that may hold them, are looked at."""
    lake = Lake(spark, scratch_dir(spark, "since"))
    number = F.col("order_id").cast("long")
    items = written_warehouse(spark, sf_dir).silver("stg_order_items").select("order_id", "order_item_id")
    day = F.floor(number / 4 % 30).cast("int")
    first = _moment("2024-01-01 00:00:00")
    for version, mode, rows, at in (
        ("load-1", "replace", items, first + F.make_dt_interval(days=day)),
        ("load-2", "append", items.where(number % 97 == 0), first + F.make_dt_interval(days=F.lit(30))),
    ):
        parts = in_parts(rows.withColumn("part", part_of(C.ITEM_KEY, 1, at)), C.ITEM_KEY)
        lake.commit(lake.stage("gold", "items", parts, version, mode, by_part=True, keys=C.ITEM_KEY))
    return quality.duplicates_since(lake, "gold", "items", C.ITEM_KEY, "load-2")[0].withColumn(
        "duplicate_count", F.col("duplicate_count").cast("int"))


@register("dq_delivered_without_date", D.sql("""
    SELECT order_id, order_status, purchased_at, delivered_to_customer_at, source_system
    FROM stg_orders WHERE order_status = 'delivered' AND delivered_to_customer_at IS NULL"""))
def dq_delivered_without_date(spark, sf_dir):
    orders = warehouse(spark, sf_dir).silver("stg_orders")
    return orders.where(checks.delivered_without_date()).select(*checks.DELIVERED_COLUMNS)


@register("audit_tables", D.sql(f"""
    SELECT 'not_flagged_items_is_negative_price' AS "check", count(*) AS failures, count(*) AS stored, 'warn' AS status
    FROM stg_order_items WHERE is_negative_price
    UNION ALL SELECT 'unique_customers_customer_unique_id', count(*), count(*), 'fail' FROM (
      SELECT 1 FROM stg_customers GROUP BY customer_unique_id HAVING count(*) > 1)
    UNION ALL SELECT 'relationships_products_category_name_pt_translation', count(*), count(DISTINCT category_name_pt), 'fail'
    FROM stg_products WHERE category_name_pt NOT IN (SELECT pt FROM b_translation)
    UNION ALL SELECT 'accepted_values_raw_order_status', count(DISTINCT order_status), count(DISTINCT order_status), 'fail'
    FROM b_orders WHERE order_status NOT IN {D.STATUSES}
    UNION ALL SELECT 'not_null_products_product_id', 0, 0, 'pass'"""))
def audit_tables(spark, sf_dir):
    """Checks that warn, fail and pass, and the failing rows that each has left in its audit table."""
    w = written_warehouse(spark, sf_dir)
    b = w.bronze
    tables = {
        "items": w.silver("stg_order_items"), "customers": w.silver("stg_customers"), "products": w.silver("stg_products"),
        "translation": b["product_category_translation"],
        "raw": silver.union_sources(b["orders"], b["live_orders"], C.ORDER_COLUMNS),
    }
    suite = quality.Suite(tables)
    suite.not_flagged("items", "is_negative_price")
    suite.unique("customers", "customer_unique_id")
    suite.relationships("products", "category_name_pt", "translation", "product_category_name")
    suite.accepted_values("raw", "order_status", C.ORDER_STATUSES)
    suite.not_null("products", "product_id")
    lake = Lake(spark, scratch_dir(spark, "audit"))
    results = quality.run_checks(suite, lake, "checks-1", raise_on_error=False)
    stored = None
    for check in suite.checks:
        rows = lake.read("audit", check.name).agg(F.lit(check.name).alias("check"), F.count(F.lit(1)).alias("stored"))
        stored = rows if stored is None else stored.unionByName(rows)
    return results.join(stored, "check").select("check", "failures", "stored", "status")


@register("schema_change_refused", D.sql("""
    SELECT order_id, order_item_id, price::DOUBLE AS price, 'batch_note, price' AS refused FROM stg_order_items"""))
def schema_change_refused(spark, sf_dir):
    """A batch with a new column and a retyped one is refused by name, and the table stays as it was."""
    lake = Lake(spark, scratch_dir(spark, "schema"))
    items = written_warehouse(spark, sf_dir).silver("stg_order_items").select("order_id", "order_item_id", "price")
    write_keyed(lake, "gold", "items", items, C.ITEM_KEY, "run-1", 2)
    other = items.withColumns({"price": F.col("price").cast("string"), "batch_note": F.lit("x")})
    refused = ""
    try:
        write_keyed(lake, "gold", "items", other, C.ITEM_KEY, "run-2", 2)
    except ValueError as error:
        refused = str(error).rpartition(": ")[2]
    return lake.read("gold", "items").withColumn("refused", F.lit(refused))


def _totals(w: Warehouse, persons: DataFrame) -> DataFrame:
    return gold.revenue_totals(
        w.fct_orders, w.mart_daily_revenue, w.mart_category_performance, persons
    )


_TOTALS = """
    SELECT (SELECT sum(order_total) FROM fct_orders WHERE is_valid_for_revenue)::DOUBLE
             AS fct_orders_revenue,
           (SELECT sum(revenue) FROM mart_daily_revenue)::DOUBLE AS daily_revenue,
           (SELECT sum(total_revenue) FROM mart_category_performance)::DOUBLE AS category_revenue,
           (SELECT sum(lifetime_value) FROM dim_customers {where})::DOUBLE AS customer_revenue"""


@register("revenue_totals", D.sql(_TOTALS.format(where="")))
def revenue_totals(spark, sf_dir):
    w = gold_warehouse(spark, sf_dir)
    return _totals(w, w.dim_customers)


@register("dq_revenue_reconciles", D.sql(f"""
    SELECT * FROM ({_TOTALS.format(where="")})
    WHERE abs(fct_orders_revenue - daily_revenue) > 0.01
       OR abs(fct_orders_revenue - category_revenue) > 0.01
       OR abs(fct_orders_revenue - customer_revenue) > 0.01"""))
def dq_revenue_reconciles(spark, sf_dir):
    w = gold_warehouse(spark, sf_dir)
    return checks.revenue_drift(_totals(w, w.dim_customers))


@register("dq_revenue_drift", D.sql(_TOTALS.format(where="WHERE state <> 'N0'")))
def dq_revenue_drift(spark, sf_dir):
    """The same check when the customer dimension lost a state: the totals come back."""
    w = gold_warehouse(spark, sf_dir)
    return checks.revenue_drift(_totals(w, w.dim_customers.where("state <> 'N0'")))


def _suite_oracle() -> str:
    def row(name: str, severity: str, count: str) -> str:
        return (
            f"SELECT '{name}' AS \"check\", '{severity}' AS severity, "
            f"({count})::BIGINT AS failures"
        )

    def source(table: str) -> str:
        return "stg_order_items" if table == "fct_order_items" else table

    rows = []
    for table, column in checks.NOT_NULL:
        rows.append(row(f"not_null_{table}_{column}", "error",
                        f"SELECT count(*) FROM {source(table)} WHERE {column} IS NULL"))
    for table, column in checks.UNIQUE:
        rows.append(row(f"unique_{table}_{column}", "error",
                        f"SELECT count(*) FROM (SELECT {column} FROM {table} "
                        f"WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"))
    for table, columns in checks.UNIQUE_COMBINATION:
        keys = ", ".join(columns)
        rows.append(row(f"unique_combination_{table}_{'_'.join(columns)}", "error",
                        f"SELECT count(*) FROM (SELECT {keys} FROM {source(table)} "
                        f"GROUP BY {keys} HAVING count(*) > 1)"))
    for table, column, parent, key in checks.RELATIONSHIPS:
        rows.append(row(f"relationships_{table}_{column}_{parent}", "error",
                        f"SELECT count(*) FROM {table} AS c WHERE c.{column} IS NOT NULL AND "
                        f"NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{key} = c.{column})"))
    for table, column in checks.NOT_FLAGGED:
        rows.append(row(f"not_flagged_{table}_{column}", "warn",
                        f"SELECT count(*) FROM {table} WHERE {column}"))
    rows.append(row("accepted_values_stg_orders_order_status", "error",
                    f"SELECT count(DISTINCT order_status) FROM stg_orders "
                    f"WHERE order_status NOT IN {D.STATUSES}"))
    rows.append(row("delivered_orders_have_delivery_date", "warn",
                    "SELECT count(*) FROM stg_orders WHERE order_status = 'delivered' "
                    "AND delivered_to_customer_at IS NULL"))
    rows.append(row("gold_revenue_reconciles", "error",
                    f"SELECT count(*) FROM ({_TOTALS.format(where='')}) "
                    "WHERE greatest(abs(fct_orders_revenue - daily_revenue), "
                    "abs(fct_orders_revenue - category_revenue), "
                    "abs(fct_orders_revenue - customer_revenue)) > 0.01"))
    union = " UNION ALL ".join(rows)
    return D.sql(f"""
        SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail'
                       ELSE 'warn' END AS status
        FROM ({union})""")


@register("quality_report", _suite_oracle())
def quality_report(spark, sf_dir):
    return quality.report(checks.build_suite(all_tables(checked_warehouse(spark, sf_dir))))
