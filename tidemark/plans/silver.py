"""Silver relations: typed, cleaned and one row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import blank_to_null, initcap_words, money, parse_ts, tidy, whole_number, zip5
from tidemark.operators.joins import left_join_spread_nulls
from tidemark.operators.latest import latest_per_key

Bronze = Mapping[str, DataFrame]


def _lineage(with_file: bool = True) -> dict[str, Column]:
    columns = {"ingested_at": F.col("_ingested_at").cast("timestamp")}
    if with_file:
        columns["source_file"] = F.col("_source_file")
    columns["batch_id"] = F.col("_batch_id")
    return columns


def _project(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.select(*[expression.alias(name) for name, expression in columns.items()])


def union_sources(history: DataFrame, live: DataFrame, columns: Sequence[str]) -> DataFrame:
    """History and live copies in one relation, told apart by ``source_system``."""
    wanted = [*columns, *C.LINEAGE]
    return history.select(*wanted, F.lit(C.SOURCE_HISTORY).alias("source_system")).unionByName(
        live.select(*wanted, F.lit(C.SOURCE_LIVE).alias("source_system"))
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Typed orders, still with every copy."""
    customer = blank_to_null("customer_id")
    return _project(raw, {
        "order_id": tidy("order_id"),
        "customer_id": customer,
        "order_status": F.lower(tidy("order_status")),
        "purchased_at": parse_ts("order_purchase_timestamp"),
        "approved_at": parse_ts("order_approved_at"),
        "delivered_to_carrier_at": parse_ts("order_delivered_carrier_date"),
        "delivered_to_customer_at": parse_ts("order_delivered_customer_date"),
        "estimated_delivery_at": parse_ts("order_estimated_delivery_date"),
        "is_missing_customer": customer.isNull(),
        "source_system": F.col("source_system"),
        **_lineage(),
    })


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Typed order items, still with every copy."""
    return _project(raw, {
        "order_id": tidy("order_id"),
        "order_item_id": whole_number("order_item_id"),
        "product_id": blank_to_null("product_id"),
        "seller_id": blank_to_null("seller_id"),
        "shipping_limit_at": parse_ts("shipping_limit_date"),
        "price": money("price"),
        "freight_value": money("freight_value"),
        "source_system": F.col("source_system"),
        **_lineage(),
    })


def clean_order_payments(raw: DataFrame) -> DataFrame:
    """Typed payments, still with every copy."""
    return _project(raw, {
        "order_id": tidy("order_id"),
        "payment_sequential": whole_number("payment_sequential"),
        "payment_type": F.lower(tidy("payment_type")),
        "payment_installments": whole_number("payment_installments"),
        "payment_value": money("payment_value"),
        "source_system": F.col("source_system"),
        **_lineage(),
    })


def finish_order_items(items: DataFrame) -> DataFrame:
    """Derived item columns, computed on the surviving copies only."""
    return items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_at",
        "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total"),
        (F.col("price") < 0).alias("is_negative_price"),
        "source_system", "ingested_at", "source_file", "batch_id",
    )


def finish_order_payments(
    payments: DataFrame, accepted: Sequence[str] = C.ACCEPTED_PAYMENT_TYPES
) -> DataFrame:
    return payments.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
        (~F.col("payment_type").isin(*accepted)).alias("is_unknown_payment_type"),
        "source_system", "ingested_at", "source_file", "batch_id",
    )


def stg_orders(history: DataFrame, live: DataFrame) -> DataFrame:
    cleaned = clean_orders(union_sources(history, live, C.ORDER_COLUMNS))
    return latest_per_key(cleaned, C.ORDER_KEY)


def stg_order_items(history: DataFrame, live: DataFrame) -> DataFrame:
    cleaned = clean_order_items(union_sources(history, live, C.ITEM_COLUMNS))
    return finish_order_items(latest_per_key(cleaned, C.ITEM_KEY))


def stg_order_payments(
    history: DataFrame, live: DataFrame, accepted: Sequence[str] = C.ACCEPTED_PAYMENT_TYPES
) -> DataFrame:
    cleaned = clean_order_payments(union_sources(history, live, C.PAYMENT_COLUMNS))
    return finish_order_payments(latest_per_key(cleaned, C.PAYMENT_KEY), accepted)


def _place(df: DataFrame, side: str, extra: Sequence[str] = ()) -> DataFrame:
    """Customers and sellers share the cleaning of their address columns."""
    return _project(df, {
        **{name: tidy(name) for name in (f"{side}_id", *extra)},
        "zip_code_prefix": zip5(f"{side}_zip_code_prefix"),
        "city": initcap_words(tidy(f"{side}_city")),
        "state": F.upper(tidy(f"{side}_state")),
        **_lineage(with_file=False),
    })


def stg_customers(customers: DataFrame) -> DataFrame:
    """``customer_id`` is issued per order; ``customer_unique_id`` is the person."""
    return _place(customers, "customer", ["customer_unique_id"])


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return _place(sellers, "seller")


def stg_products(products: DataFrame, translations: DataFrame) -> DataFrame:
    """Products with the English category name where there is one.

    The translation side is one row per category name. It is not forced to be broadcast:
    Spark does that itself while its measured size is below the threshold, and beyond it
    products without a category do not pile up on one task.
    """
    lookup = translations.select(
        tidy("product_category_name").alias("_name"),
        tidy("product_category_name_english").alias("_english"),
    )
    source_name = F.col("product_category_name")
    joined = left_join_spread_nulls(
        products.withColumn("_name", tidy(source_name)), lookup, "_name", spread_by="product_id"
    )
    numbers = {
        "name_length": "product_name_lenght",
        "description_length": "product_description_lenght",
        "photos_qty": "product_photos_qty",
        "weight_g": "product_weight_g",
        "length_cm": "product_length_cm",
        "height_cm": "product_height_cm",
        "width_cm": "product_width_cm",
    }
    return _project(joined, {
        "product_id": tidy("product_id"),
        "category": F.coalesce(F.col("_english"), tidy(source_name), F.lit("unknown")),
        "category_name_pt": tidy(source_name),
        "is_missing_translation": source_name.isNotNull() & F.col("_english").isNull(),
        **{name: whole_number(raw) for name, raw in numbers.items()},
        **_lineage(with_file=False),
    })


def silver_relations(
    payment_types: Sequence[str] = C.ACCEPTED_PAYMENT_TYPES,
) -> dict[str, Callable[[Bronze], DataFrame]]:
    """Every silver relation as a function of the bronze tables."""
    return {
        **SILVER,
        "stg_order_payments": lambda b: stg_order_payments(
            b["order_payments"], b["live_order_payments"], payment_types
        ),
    }


SILVER: dict[str, Callable[[Bronze], DataFrame]] = {
    "stg_orders": lambda b: stg_orders(b["orders"], b["live_orders"]),
    "stg_order_items": lambda b: stg_order_items(b["order_items"], b["live_order_items"]),
    "stg_order_payments": lambda b: stg_order_payments(
        b["order_payments"], b["live_order_payments"]
    ),
    "stg_customers": lambda b: stg_customers(b["customers"]),
    "stg_products": lambda b: stg_products(b["products"], b["product_category_translation"]),
    "stg_sellers": lambda b: stg_sellers(b["sellers"]),
}
