"""Fixed values and declared shapes of the pipeline: layers, files, columns, checks."""

from __future__ import annotations

# --- Fixed values: they must equal what users' existing data and reports contain. ---------

LAYERS = ("bronze", "silver", "gold", "audit", "snapshots")

# CSV file -> bronze table (full refresh).
HISTORY_FILES = {
    "olist_customers_dataset.csv": "customers",
    "olist_geolocation_dataset.csv": "geolocation",
    "olist_orders_dataset.csv": "orders",
    "olist_order_items_dataset.csv": "order_items",
    "olist_order_payments_dataset.csv": "order_payments",
    "olist_order_reviews_dataset.csv": "order_reviews",
    "olist_products_dataset.csv": "products",
    "olist_sellers_dataset.csv": "sellers",
    "product_category_name_translation.csv": "product_category_translation",
}

# Landing folder -> bronze table (append, exactly once per file).
LANDING_TABLES = {
    "orders": "live_orders",
    "order_items": "live_order_items",
    "order_payments": "live_order_payments",
}

SOURCE_HISTORY = "olist"
SOURCE_LIVE = "live"

ACCEPTED_PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
ORDER_STATUSES = (
    "created", "approved", "invoiced", "processing",
    "shipped", "delivered", "canceled", "unavailable",
)
NON_REVENUE_STATUSES = ("canceled", "unavailable")

LOOKBACK_HOURS = 1
RECONCILE_TOLERANCE = "0.01"
SEGMENT_HIGH = 1000
SEGMENT_MEDIUM = 200
WEIGHT_MEDIUM_G = 500
WEIGHT_LARGE_G = 5000
SAMPLE_SIZE = 5000

# --- Declared bronze columns (all text). ---------------------------------------------------

LINEAGE = ("_ingested_at", "_source_file", "_batch_id")

ORDER_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
ITEM_COLUMNS = (
    "order_id", "order_item_id", "product_id", "seller_id",
    "shipping_limit_date", "price", "freight_value",
)
PAYMENT_COLUMNS = (
    "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
)

# The bronze tables that models may read. Geolocation and reviews are loaded only; their
# columns come from the file header.
BRONZE_COLUMNS = {
    "orders": ORDER_COLUMNS,
    "order_items": ITEM_COLUMNS,
    "order_payments": PAYMENT_COLUMNS,
    "live_orders": ORDER_COLUMNS,
    "live_order_items": ITEM_COLUMNS,
    "live_order_payments": PAYMENT_COLUMNS,
    "customers": (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ),
    "products": (
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "product_category_translation": (
        "product_category_name", "product_category_name_english",
    ),
}

# --- Grains. -------------------------------------------------------------------------------

ORDER_KEY = ["order_id"]
ITEM_KEY = ["order_id", "order_item_id"]
PAYMENT_KEY = ["order_id", "payment_sequential"]
