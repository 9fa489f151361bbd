"""Reference data for new orders, and a profile of the defects bronze holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import blank_to_null, tidy


def product_seller_avg_price(items: DataFrame) -> DataFrame:
    """Mean listed price per product and seller over the raw history items."""
    price = blank_to_null("price").cast("decimal(18,4)")
    sums = items.groupBy("product_id", "seller_id").agg(
        F.sum(price).cast("decimal(22,4)").alias("total"),
        F.count(price).cast("decimal(12,0)").alias("n"),
    )
    mean = F.round(F.col("total") / F.nullif(F.col("n"), F.lit(0).cast("decimal(12,0)")), 6)
    return sums.select("product_id", "seller_id", mean.alias("avg_price"))


def defect_profile(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    accepted: tuple[str, ...] = C.ACCEPTED_PAYMENT_TYPES,
) -> DataFrame:
    """How many raw rows show each known defect: one pass per relation.

    A duplicate order is every copy of an order id beyond its first; copies are counted per
    id before the sum, so nothing but counts leaves the map side.
    """
    raw_status = F.col("order_status")
    order_counts = orders.agg(
        F.count_if(blank_to_null("customer_id").isNull()).alias("missing_customer"),
        F.count_if(raw_status != F.lower(tidy(raw_status))).alias("messy_status"),
        F.count_if(F.col("order_purchase_timestamp").contains("T")).alias("iso_timestamp"),
    )
    copies = (
        orders.groupBy("order_id").agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_order"))
    )
    prices = items.agg(
        F.count_if(blank_to_null("price").cast("decimal(18,4)") < 0).alias("negative_price")
    )
    unknown = ~F.lower(tidy("payment_type")).isin(*accepted)
    kinds = payments.agg(F.count_if(unknown).alias("unknown_payment_type"))

    def long_form(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "issue", "row_count")

    return (
        long_form(copies)
        .unionByName(long_form(order_counts))
        .unionByName(long_form(prices))
        .unionByName(long_form(kinds))
    )
