"""The checks of this pipeline."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators.quality import WARN, Suite
from tidemark.plans.gold import revenue_totals

DELIVERED_COLUMNS = (
    "order_id", "order_status", "purchased_at", "delivered_to_customer_at", "source_system",
)


def delivered_without_date() -> Column:
    return (F.col("order_status") == "delivered") & F.col("delivered_to_customer_at").isNull()


def revenue_drift(totals: DataFrame, tolerance: str = C.RECONCILE_TOLERANCE) -> DataFrame:
    """The totals, if any gold relation is off by more than the tolerance."""
    limit = F.lit(tolerance).cast("decimal(12,2)")

    def differs(other: str):
        return F.abs(F.col("fct_orders_revenue") - F.col(other)) > limit

    return totals.where(
        differs("daily_revenue") | differs("category_revenue") | differs("customer_revenue")
    )


# What has to hold, per kind of check (fixed values).

NOT_NULL = (
    ("stg_orders", "order_id"), ("stg_orders", "purchased_at"),
    ("stg_order_items", "order_id"),
    ("stg_customers", "customer_id"), ("stg_customers", "customer_unique_id"),
    ("stg_products", "product_id"), ("stg_sellers", "seller_id"),
    ("fct_orders", "order_id"), ("fct_orders", "order_total"),
    ("fct_orders", "is_valid_for_revenue"),
    ("dim_customers", "customer_unique_id"), ("dim_customers", "lifetime_value"),
    ("dim_products", "product_id"), ("dim_products", "category"),
    ("mart_daily_revenue", "order_date"), ("mart_category_performance", "category"),
    ("fct_order_items", "order_id"), ("fct_order_items", "item_total"),
)
UNIQUE = (
    ("stg_orders", "order_id"), ("stg_customers", "customer_id"),
    ("stg_products", "product_id"), ("stg_sellers", "seller_id"),
    ("fct_orders", "order_id"), ("dim_customers", "customer_unique_id"),
    ("dim_products", "product_id"), ("mart_daily_revenue", "order_date"),
    ("mart_category_performance", "category"),
)
UNIQUE_COMBINATION = (
    ("stg_order_items", tuple(C.ITEM_KEY)),
    ("stg_order_payments", tuple(C.PAYMENT_KEY)),
    ("fct_order_items", tuple(C.ITEM_KEY)),
)
RELATIONSHIPS = (
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("stg_order_items", "product_id", "stg_products", "product_id"),
    ("stg_order_payments", "order_id", "stg_orders", "order_id"),
    ("fct_orders", "customer_unique_id", "dim_customers", "customer_unique_id"),
)
NOT_FLAGGED = (
    ("stg_orders", "is_missing_customer"),
    ("stg_order_items", "is_negative_price"),
    ("stg_order_payments", "is_unknown_payment_type"),
)
ACCEPTED_VALUES = (("stg_orders", "order_status", C.ORDER_STATUSES),)


def build_suite(tables: Mapping[str, DataFrame]) -> Suite:
    """All 41 checks over the six silver and six gold relations, named as in the layers."""
    s = Suite(tables)
    for check in NOT_NULL:
        s.not_null(*check)
    for check in UNIQUE:
        s.unique(*check)
    for check in UNIQUE_COMBINATION:
        s.unique_combination(*check)
    for check in RELATIONSHIPS:
        s.relationships(*check)
    for check in NOT_FLAGGED:
        s.not_flagged(*check)
    for check in ACCEPTED_VALUES:
        s.accepted_values(*check)
    s.rows_where(
        "delivered_orders_have_delivery_date", "stg_orders", delivered_without_date(),
        DELIVERED_COLUMNS, WARN,
    )
    s.query("gold_revenue_reconciles", revenue_drift(revenue_totals(
        tables["fct_orders"], tables["mart_daily_revenue"],
        tables["mart_category_performance"], tables["dim_customers"],
    )))
    return s
