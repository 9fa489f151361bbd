"""Gold relations: order fact, dimensions and marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark import config as C
from tidemark.functions import days_between, ratio
from tidemark.operators.joins import inner_join_spread, left_join_spread_nulls

_MONEY_SUM = "decimal(38,2)"

# The silver columns that the gold relations are made of (of products: all).
SILVER_COLUMNS = {
    "stg_orders": (
        "order_id", "customer_id", "order_status", "purchased_at", "delivered_to_customer_at",
        "estimated_delivery_at", "is_missing_customer", "source_system",
    ),
    "stg_order_items": (
        "order_id", "product_id", "price", "freight_value", "item_total", "is_negative_price",
    ),
    "stg_order_payments": ("order_id", "payment_value", "is_unknown_payment_type"),
    "stg_customers": ("customer_id", "customer_unique_id", "city", "state", "zip_code_prefix"),
}


def _zero_if_null(name: str):
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _false_if_null(name: str):
    return F.coalesce(F.col(name), F.lit(False)).alias(name)


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.sum("price").alias("items_value"),
        F.sum("freight_value").alias("freight_value"),
        F.sum("item_total").alias("order_total"),
        F.bool_or("is_negative_price").alias("has_negative_price"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count("*").alias("payment_count"),
        F.sum("payment_value").alias("total_paid"),
        F.bool_or("is_unknown_payment_type").alias("has_unknown_payment_type"),
    )


def fct_orders(
    orders: DataFrame, items: DataFrame, payments: DataFrame, customers: DataFrame,
    hot_customers: Sequence[str] = (),
) -> DataFrame:
    """One row per order with item, payment, delivery and quality measures. ``hot_customers`` are ids with very many
    orders (:func:`heavy_keys`), whose join is salted.

    Items and payments are reduced to one row per order before they are joined. The three
    sides meet on ``order_id`` first, so orders are shuffled once for deduplication and both
    joins; the customer join, the only one on another key, comes last.
    """
    persons = customers.select(
        "customer_id", "customer_unique_id", F.col("state").alias("customer_state")
    )
    per_order = (
        orders.join(items_per_order(items), "order_id", "left")
        .join(payments_per_order(payments), "order_id", "left")
    )
    joined = left_join_spread_nulls(per_order, persons, "customer_id", "order_id", hot_customers)

    delivered = F.col("delivered_to_customer_at")
    base = joined.select(
        "order_id", "customer_id", "customer_unique_id", "customer_state", "order_status",
        "purchased_at", F.to_date("purchased_at").alias("order_date"),
        "delivered_to_customer_at", "estimated_delivery_at",
        *[_zero_if_null(c) for c in (
            "item_count", "items_value", "freight_value", "order_total",
            "payment_count", "total_paid",
        )],
        _false_if_null("has_negative_price"),
        _false_if_null("has_unknown_payment_type"),
        "is_missing_customer", "source_system",
    )
    return base.withColumns({
        "payment_gap": F.col("total_paid") - F.col("order_total"),
        "delivery_days": F.when(
            delivered.isNotNull(), days_between("purchased_at", "delivered_to_customer_at")
        ),
        "is_late_delivery": F.when(
            delivered.isNotNull(), F.to_date(delivered) > F.to_date("estimated_delivery_at")
        ),
        "is_valid_for_revenue": (
            ~F.col("has_negative_price")
            & ~F.col("has_unknown_payment_type")
            & ~F.col("is_missing_customer")
            & (F.col("item_count") > 0)
            & ~F.col("order_status").isin(*C.NON_REVENUE_STATUSES)
        ),
    })


def dim_products(products: DataFrame) -> DataFrame:
    weight = F.col("weight_g")
    return products.select(
        "product_id", "category", "category_name_pt", "is_missing_translation",
        "photos_qty", "weight_g", "length_cm", "height_cm", "width_cm",
        (F.col("length_cm") * F.col("height_cm") * F.col("width_cm")).alias("volume_cm3"),
        F.when(weight.isNull(), "unknown")
        .when(weight < C.WEIGHT_MEDIUM_G, "small")
        .when(weight < C.WEIGHT_LARGE_G, "medium")
        .otherwise("large")
        .alias("size_band"),
    )


def _valid_sum(name: str):
    total = F.sum(F.when(F.col("is_valid_for_revenue"), F.col(name)))
    return F.coalesce(total, F.lit(0)).cast(_MONEY_SUM)


def value_segment(lifetime_value):
    return (
        F.when(lifetime_value >= C.SEGMENT_HIGH, "high")
        .when(lifetime_value >= C.SEGMENT_MEDIUM, "medium")
        .when(lifetime_value > 0, "low")
        .otherwise("no_valid_orders")
    )


def person_stats(fct: DataFrame) -> DataFrame:
    """Per person: order counts, dates, valid revenue and the id used on the latest order.

    The latest order is found by the same aggregate (a maximum over a struct, NULL
    timestamps highest), so orders are shuffled once, partially aggregated first: a person
    with a third of all orders sends one row per map task.
    """
    recency = F.struct(
        F.col("purchased_at").isNull(), "purchased_at",
        F.col("order_id").isNull(), "order_id",
    )
    return (
        fct.where(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_if("is_valid_for_revenue").alias("valid_orders"),
            F.min("purchased_at").alias("first_order_at"),
            F.max("purchased_at").alias("last_order_at"),
            _valid_sum("order_total").alias("lifetime_value"),
            F.max_by("customer_id", recency).alias("customer_id"),
        )
    )


def one_location_per_id(customers: DataFrame) -> DataFrame:
    """City, state and zip per customer id; the highest wins should an id repeat."""
    place = F.struct("city", "state", "zip_code_prefix")
    return customers.groupBy("customer_id").agg(F.max(place).alias("place")).select(
        "customer_id", "place.*"
    )


def latest_location(fct: DataFrame, customers: DataFrame) -> DataFrame:
    """Where each person's most recent order went."""
    return (
        person_stats(fct)
        .select("customer_unique_id", "customer_id")
        .join(one_location_per_id(customers), "customer_id", "left")
        .select("customer_unique_id", "city", "state", "zip_code_prefix")
    )


def dim_customers(fct: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per person. Location is looked up after orders shrink to one row each."""
    stats = person_stats(fct)
    located = stats.join(one_location_per_id(customers), "customer_id", "left")
    return located.select(
        "customer_unique_id", "city", "state", "zip_code_prefix",
        "total_orders", "valid_orders", "first_order_at", "last_order_at", "lifetime_value",
        F.when(
            F.col("valid_orders") > 0, ratio(F.col("lifetime_value"), F.col("valid_orders"))
        ).alias("avg_order_value"),
        (F.col("total_orders") > 1).alias("is_repeat_customer"),
        value_segment(F.col("lifetime_value")).alias("value_segment"),
    )


def mart_daily_revenue(fct: DataFrame) -> DataFrame:
    """Daily KPIs. The one distinct count is planned in two steps on (day, person), so a
    day with a third of all orders is spread over its persons before it is reduced."""
    valid = F.col("is_valid_for_revenue")
    delivered = F.count_if(F.col("delivered_to_customer_at").isNotNull())
    late = F.count_if("is_late_delivery")
    return (
        fct.groupBy("order_date")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_if(valid).alias("valid_orders"),
            _valid_sum("order_total").alias("revenue"),
            _valid_sum("items_value").alias("items_revenue"),
            _valid_sum("freight_value").alias("freight_revenue"),
            F.count_distinct(F.when(valid, F.col("customer_unique_id"))).alias("unique_customers"),
            delivered.alias("delivered_orders"),
            late.alias("late_deliveries"),
        )
        .select(
            "order_date", "total_orders", "valid_orders",
            "revenue", "items_revenue", "freight_revenue",
            F.when(
                F.col("valid_orders") > 0, ratio(F.col("revenue"), F.col("valid_orders"))
            ).alias("avg_order_value"),
            "unique_customers", "delivered_orders", "late_deliveries",
            ratio(100 * F.col("late_deliveries"), F.col("delivered_orders")).alias(
                "late_delivery_pct"
            ),
        )
    )


def valid_items(items: DataFrame, fct: DataFrame, hot_orders: Sequence[str] = ()) -> DataFrame:
    """Items of orders that count as revenue."""
    counted = fct.where("is_valid_for_revenue").select("order_id", "customer_unique_id")
    sold = items.select("order_id", "product_id", "price", "freight_value", "item_total")
    return inner_join_spread(sold, counted, "order_id", ["product_id", "price"], hot_orders)


def with_share_and_rank(groups: DataFrame, amount: str, share: str, position: str) -> DataFrame:
    """Percentage of the grand total and rank by amount, ties sharing a rank, NULL first.

    For aggregated input only: both windows span all rows, here one per group.
    """
    whole = F.sum(amount).over(Window.partitionBy()).cast("decimal(22,2)")
    return groups.withColumns({
        share: F.round(100 * F.col(amount).cast("decimal(22,2)") / whole, 2),
        position: F.rank().over(Window.orderBy(F.desc_nulls_first(amount))),
    })


def mart_category_performance(
    items: DataFrame, fct: DataFrame, products: DataFrame,
    hot_orders: Sequence[str] = (), hot_products: Sequence[str] = (),
) -> DataFrame:
    """Volume, revenue, share and rank per category over valid orders. ``hot_orders`` and ``hot_products`` are ids
    with very many items (:func:`heavy_keys`), whose joins are salted.

    Orders and customers are both counted distinct: where a customer id repeats in the customer
    list, an order has a fact row for each person. Both counts run in one aggregate keyed by (category, distinct
    value), which spreads a hot category; the window after it sees one row per category.
    """
    categories = products.select("product_id", "category")
    sold = left_join_spread_nulls(
        valid_items(items, fct, hot_orders), categories, "product_id", "order_id", hot_products
    )
    per_category = sold.groupBy(F.coalesce("category", F.lit("unknown")).alias("category")).agg(
        F.count("*").alias("units_sold"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_unique_id").alias("customers"),
        F.sum("price").cast(_MONEY_SUM).alias("items_revenue"),
        F.sum("freight_value").cast(_MONEY_SUM).alias("freight_revenue"),
        F.sum("item_total").cast(_MONEY_SUM).alias("total_revenue"),
        F.count("price").alias("priced_units"),
    )
    with_mean = per_category.withColumn(
        "avg_item_price", ratio(F.col("items_revenue"), F.col("priced_units"))
    )
    return with_share_and_rank(
        with_mean, "total_revenue", "revenue_share_pct", "revenue_rank"
    ).select(
        "category", "units_sold", "orders", "customers",
        "items_revenue", "freight_revenue", "total_revenue",
        "avg_item_price", "revenue_share_pct", "revenue_rank",
    )


def revenue_totals(
    fct: DataFrame, daily: DataFrame, category: DataFrame, persons: DataFrame
) -> DataFrame:
    """Valid revenue as each gold relation reports it: one row, four columns.

    Four one-row totals, stacked and folded into one row.
    """
    names = ("fct_orders_revenue", "daily_revenue", "category_revenue", "customer_revenue")
    totals = (
        fct.agg(_valid_sum("order_total").alias("amount")),
        daily.agg(F.sum("revenue").cast(_MONEY_SUM).alias("amount")),
        category.agg(F.sum("total_revenue").cast(_MONEY_SUM).alias("amount")),
        persons.agg(F.sum("lifetime_value").cast(_MONEY_SUM).alias("amount")),
    )
    stacked = None
    for name, total in zip(names, totals):
        tagged = total.select(F.lit(name).alias("relation"), "amount")
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    amount = F.col("amount")
    return stacked.agg(*[
        F.coalesce(F.max(F.when(F.col("relation") == name, amount)), F.lit(0))
        .cast(_MONEY_SUM)
        .alias(name)
        for name in names
    ])
