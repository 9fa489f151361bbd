"""The registered queries written a second time, as DuckDB SQL over the same parquet tables.

``CTES`` holds one relation per entry, in dependency order; ``sql(select)`` puts them all in
front of a final select (DuckDB drops the ones that are not referenced). Money is kept in
decimals and quotients are taken in whole hundredths, so that nothing is rounded twice; the
final selects cast decimals to DOUBLE, as the Spark side does.
"""

from __future__ import annotations

ACCEPTED = "('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')"
STATUSES = (
    "('created', 'approved', 'invoiced', 'processing', "
    "'shipped', 'delivered', 'canceled', 'unavailable')"
)
STAMP = "'%Y-%m-%d %H:%M:%S'"


def half_up(numerator: str, denominator: str, scale: int = 100) -> str:
    """``numerator / denominator`` rounded half away from zero, both whole numbers, the
    result divided by ``scale``; NULL where the denominator is 0."""
    n, d = f"({numerator})::HUGEINT", f"nullif(({denominator})::HUGEINT, 0)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))::DOUBLE / {scale}"


def cents(expression: str) -> str:
    return f"({expression}) * 100"


def wall_clock(column: str) -> str:
    """Either timestamp layout to TIMESTAMP, blank to NULL."""
    return (
        f"CAST(nullif(translate(rtrim(trim({column}, ' '), 'Z'), 'T', ' '), '') AS TIMESTAMP)"
    )


def capitalised(column: str) -> str:
    s = f"lower(trim({column}, ' '))"
    return (
        f"array_to_string(list_transform(string_split({s}, ''), lambda c, i: "
        f"CASE WHEN i = 1 OR NOT regexp_matches(substr({s}, (i - 1)::INT, 1), '[\\p{{L}}\\p{{N}}]') "
        f"THEN upper(c) ELSE c END), '')"
    )


def padded(column: str) -> str:
    return f"lpad(trim({column}, ' '), 5, '0')"


INGESTED = "CAST(left(_ingested_at, 19) AS TIMESTAMP)"
LIVE_TIME = (
    "strftime(TIMESTAMP '2024-01-02' + to_hours(({h})::INT), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
)
HISTORY_TIME = "'2024-01-01T00:00:00+00:00'"

CTES: dict[str, str] = {}

# --- bronze ---------------------------------------------------------------------------------

CTES["order_base"] = f"""
SELECT o_orderkey AS k, o_orderdate AS d,
       CASE WHEN o_orderkey % 53 = 0 THEN 'canceled'
            WHEN o_orderkey % 59 = 0 THEN 'unavailable'
            WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'shipped'
            ELSE 'processing' END AS state,
       o_orderdate + to_seconds(o_orderkey % 86400) AS bought
FROM orders"""

CTES["order_text"] = f"""
SELECT k, k::VARCHAR AS order_id,
       CASE WHEN k % 47 = 0 THEN '' ELSE 'c' || k END AS customer_id,
       CASE WHEN k % 11 = 0 THEN ' ' || upper(state) || ' ' ELSE state END AS order_status,
       CASE WHEN k % 13 = 0 THEN strftime(bought, '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(bought, {STAMP}) END AS order_purchase_timestamp,
       CASE WHEN k % 5 = 0 THEN '' WHEN k % 13 = 0 THEN strftime(bought, '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(bought, {STAMP}) END AS order_approved_at,
       CASE WHEN state = 'delivered' AND k % 97 <> 0
            THEN strftime(d + INTERVAL 1 DAY, {STAMP}) END AS order_delivered_carrier_date,
       CASE WHEN state = 'delivered' AND k % 97 <> 0
            THEN strftime(d + to_days((k % 30 + 1)::INT), {STAMP}) END
            AS order_delivered_customer_date,
       strftime(d + INTERVAL 20 DAY, {STAMP}) AS order_estimated_delivery_date
FROM order_base"""

CTES["b_orders"] = f"""
SELECT * REPLACE (CASE WHEN k % 40 = 0 THEN 'created' ELSE order_status END AS order_status),
       {HISTORY_TIME} AS _ingested_at, 'orders.csv' AS _source_file, 'history' AS _batch_id,
       'olist' AS source_system
FROM order_text WHERE k % 10 <> 0 OR k % 40 = 0
UNION ALL BY NAME
SELECT *, {LIVE_TIME.format(h="k % 72")} AS _ingested_at,
       'orders/orders_' || (k % 72) || '.jsonl' AS _source_file, 'live-' || (k % 72) AS _batch_id,
       'live' AS source_system
FROM order_text WHERE k % 10 = 0"""

CTES["b_items"] = f"""
WITH cents AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) % 20000 AS c FROM lineitem
)
SELECT l_orderkey::VARCHAR AS order_id, l_linenumber::VARCHAR AS order_item_id,
       l_partkey::VARCHAR AS product_id, l_suppkey::VARCHAR AS seller_id,
       strftime(l_shipdate, {STAMP}) AS shipping_limit_date,
       CASE WHEN l_orderkey % 71 = 0 AND l_linenumber = 1 THEN '-' ELSE '' END
         || (c // 100) || '.' || lpad((c % 100)::VARCHAR, 2, '0') AS price,
       l_quantity::VARCHAR AS freight_value,
       CASE WHEN l_orderkey % 10 = 0 THEN {LIVE_TIME.format(h="l_partkey % 72")}
            ELSE {HISTORY_TIME} END AS _ingested_at,
       'items_' || lpad(l_partkey::VARCHAR, 10, '0') || '_' || lpad(l_suppkey::VARCHAR, 10, '0')
         || '_' || l_quantity::VARCHAR || '_' || l_extendedprice::VARCHAR AS _source_file,
       CASE WHEN l_orderkey % 10 = 0 THEN 'live-' || (l_partkey % 72) ELSE 'history' END AS _batch_id,
       CASE WHEN l_orderkey % 10 = 0 THEN 'live' ELSE 'olist' END AS source_system
FROM cents"""

CTES["b_payments"] = f"""
WITH both_kinds AS (
  SELECT o_orderkey AS k, '1' AS payment_sequential,
         CASE WHEN o_orderkey % 61 = 0 THEN 'UPI'
              ELSE ['credit_card', ' Boleto', 'voucher', 'not_defined', 'debit_card']
                   [o_orderpriority[1]::INT] END AS payment_type,
         (o_orderkey % 10 + 1)::VARCHAR AS payment_installments,
         o_totalprice::DECIMAL(14,2)::VARCHAR AS payment_value
  FROM orders
  UNION ALL
  SELECT o_orderkey, '2', 'voucher', '1', '10.00' FROM orders WHERE o_orderkey % 7 = 0
)
SELECT k::VARCHAR AS order_id, payment_sequential,
       CASE WHEN k % 40 = 0 THEN 'boleto' ELSE payment_type END AS payment_type,
       payment_installments, CASE WHEN k % 40 = 0 THEN '1.00' ELSE payment_value END AS payment_value,
       {HISTORY_TIME} AS _ingested_at, 'order_payments.csv' AS _source_file,
       'history' AS _batch_id, 'olist' AS source_system
FROM both_kinds WHERE k % 10 <> 0 OR k % 40 = 0
UNION ALL
SELECT k::VARCHAR, payment_sequential, payment_type, payment_installments, payment_value,
       {LIVE_TIME.format(h="k % 72")}, 'order_payments/order_payments_' || (k % 72) || '.jsonl',
       'live-' || (k % 72), 'live'
FROM both_kinds WHERE k % 10 = 0"""

CTES["b_customers"] = """
SELECT 'c' || o_orderkey AS customer_id,
       CASE WHEN o_orderkey % 5 = 0 THEN 's' || o_orderkey
            ELSE 'p' || (o_orderkey // 4) END AS customer_unique_id,
       (c_custkey % 100000)::VARCHAR AS customer_zip_code_prefix,
       ' ' || lower(n_name) || '-d''este ' || lower(c_mktsegment) || ' ' AS customer_city,
       'n' || c_nationkey AS customer_state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

CTES["b_products"] = """
SELECT p_partkey::VARCHAR AS product_id,
       CASE WHEN p_partkey % 83 <> 0 THEN p_name END AS product_category_name,
       length(p_name) AS name_length, length(p_type) AS description_length,
       p_size % 5 AS photos_qty,
       CASE WHEN p_partkey % 37 <> 0 THEN p_size * 100 END AS weight_g,
       p_size AS length_cm, p_size % 7 + 1 AS height_cm, p_size % 11 + 1 AS width_cm
FROM part"""

CTES["b_translation"] = """
SELECT DISTINCT p_name AS pt, upper(p_name) AS en FROM part WHERE length(p_name) % 5 <> 0"""

# --- silver ---------------------------------------------------------------------------------

CTES["clean_orders"] = f"""
SELECT trim(order_id, ' ') AS order_id, nullif(trim(customer_id, ' '), '') AS customer_id,
       lower(trim(order_status, ' ')) AS order_status,
       {wall_clock('order_purchase_timestamp')} AS purchased_at,
       {wall_clock('order_approved_at')} AS approved_at,
       {wall_clock('order_delivered_carrier_date')} AS delivered_to_carrier_at,
       {wall_clock('order_delivered_customer_date')} AS delivered_to_customer_at,
       {wall_clock('order_estimated_delivery_date')} AS estimated_delivery_at,
       coalesce(trim(customer_id, ' '), '') = '' AS is_missing_customer,
       source_system, {INGESTED} AS ingested_at, _source_file AS source_file, _batch_id AS batch_id
FROM b_orders"""

CTES["stg_orders"] = """
SELECT * FROM clean_orders
QUALIFY row_number() OVER (
  PARTITION BY order_id ORDER BY ingested_at DESC NULLS FIRST, source_file DESC NULLS FIRST) = 1"""

CTES["stg_order_items"] = f"""
SELECT * EXCLUDE (_ingested_at),
       price + freight_value AS item_total, price < 0 AS is_negative_price
FROM (
  SELECT order_id, order_item_id::INT AS order_item_id, product_id, seller_id,
         {wall_clock('shipping_limit_date')} AS shipping_limit_at,
         price::DECIMAL(12,2) AS price, freight_value::DECIMAL(12,2) AS freight_value,
         source_system, _ingested_at, {INGESTED} AS ingested_at,
         _source_file AS source_file, _batch_id AS batch_id
  FROM b_items
)
QUALIFY row_number() OVER (
  PARTITION BY order_id, order_item_id
  ORDER BY ingested_at DESC NULLS FIRST, source_file DESC NULLS FIRST) = 1"""

CTES["stg_order_payments"] = f"""
SELECT *, payment_type NOT IN {ACCEPTED} AS is_unknown_payment_type
FROM (
  SELECT order_id, payment_sequential::INT AS payment_sequential,
         lower(trim(payment_type, ' ')) AS payment_type,
         payment_installments::INT AS payment_installments,
         payment_value::DECIMAL(12,2) AS payment_value,
         source_system, {INGESTED} AS ingested_at, _source_file AS source_file,
         _batch_id AS batch_id
  FROM b_payments
)
QUALIFY row_number() OVER (
  PARTITION BY order_id, payment_sequential
  ORDER BY ingested_at DESC NULLS FIRST, source_file DESC NULLS FIRST) = 1"""

CTES["stg_customers"] = f"""
SELECT customer_id, customer_unique_id, {padded('customer_zip_code_prefix')} AS zip_code_prefix,
       {capitalised('customer_city')} AS city, upper(customer_state) AS state,
       TIMESTAMP '2024-01-01' AS ingested_at, 'history' AS batch_id
FROM b_customers"""

CTES["stg_products"] = """
SELECT p.product_id, coalesce(t.en, p.product_category_name, 'unknown') AS category,
       p.product_category_name AS category_name_pt,
       p.product_category_name IS NOT NULL AND t.en IS NULL AS is_missing_translation,
       name_length::INT AS name_length, description_length::INT AS description_length,
       photos_qty::INT AS photos_qty, weight_g::INT AS weight_g, length_cm::INT AS length_cm,
       height_cm::INT AS height_cm, width_cm::INT AS width_cm,
       TIMESTAMP '2024-01-01' AS ingested_at, 'history' AS batch_id
FROM b_products AS p LEFT JOIN b_translation AS t ON p.product_category_name = t.pt"""

CTES["stg_sellers"] = """
SELECT s_suppkey::VARCHAR AS seller_id,
       lpad((s_suppkey * 37)::VARCHAR, 5, '0') AS zip_code_prefix,
       'Porto/' || upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS city,
       'N' || s_nationkey AS state,
       TIMESTAMP '2024-01-01' AS ingested_at, 'history' AS batch_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

# --- gold -----------------------------------------------------------------------------------

CTES["items_per_order"] = """
SELECT order_id, count(*) AS item_count, sum(price) AS items_value,
       sum(freight_value) AS freight_value, sum(item_total) AS order_total,
       bool_or(is_negative_price) AS has_negative_price
FROM stg_order_items GROUP BY ALL"""

CTES["payments_per_order"] = """
SELECT order_id, count(*) AS payment_count, sum(payment_value) AS total_paid,
       bool_or(is_unknown_payment_type) AS has_unknown_payment_type
FROM stg_order_payments GROUP BY ALL"""

CTES["fct_orders"] = f"""
WITH measured AS (
  SELECT o.order_id, o.customer_id, c.customer_unique_id, c.state AS customer_state,
         o.order_status, o.purchased_at, o.purchased_at::DATE AS order_date,
         o.delivered_to_customer_at, o.estimated_delivery_at,
         ifnull(i.item_count, 0) AS item_count, ifnull(i.items_value, 0) AS items_value,
         ifnull(i.freight_value, 0) AS freight_value, ifnull(i.order_total, 0) AS order_total,
         ifnull(p.payment_count, 0) AS payment_count, ifnull(p.total_paid, 0) AS total_paid,
         ifnull(i.has_negative_price, false) AS has_negative_price,
         ifnull(p.has_unknown_payment_type, false) AS has_unknown_payment_type,
         o.is_missing_customer, o.source_system
  FROM stg_orders AS o
  LEFT JOIN items_per_order AS i USING (order_id)
  LEFT JOIN payments_per_order AS p USING (order_id)
  LEFT JOIN stg_customers AS c USING (customer_id)
)
SELECT *, total_paid - order_total AS payment_gap,
       {half_up("10 * epoch_us(delivered_to_customer_at) - 10 * epoch_us(purchased_at)",
                "86400000000", 10)} AS delivery_days,
       delivered_to_customer_at::DATE > estimated_delivery_at::DATE AS is_late_delivery,
       NOT (has_negative_price OR has_unknown_payment_type OR is_missing_customer)
         AND item_count > 0 AND order_status NOT IN ('canceled', 'unavailable')
         AS is_valid_for_revenue
FROM measured"""

CTES["dim_products"] = """
SELECT product_id, category, category_name_pt, is_missing_translation, photos_qty, weight_g,
       length_cm, height_cm, width_cm, length_cm * height_cm * width_cm AS volume_cm3,
       CASE WHEN weight_g >= 5000 THEN 'large' WHEN weight_g >= 500 THEN 'medium'
            WHEN weight_g IS NOT NULL THEN 'small' ELSE 'unknown' END AS size_band
FROM stg_products"""

CTES["latest_location"] = """
SELECT f.customer_unique_id, c.city, c.state, c.zip_code_prefix
FROM fct_orders AS f JOIN stg_customers AS c USING (customer_id)
WHERE f.customer_unique_id IS NOT NULL
QUALIFY row_number() OVER (
  PARTITION BY f.customer_unique_id
  ORDER BY f.purchased_at DESC NULLS FIRST, f.order_id DESC NULLS FIRST) = 1"""

CTES["dim_customers"] = f"""
WITH spending AS (
  SELECT customer_unique_id, count(*) AS total_orders,
         count(*) FILTER (is_valid_for_revenue) AS valid_orders,
         min(purchased_at) AS first_order_at, max(purchased_at) AS last_order_at,
         ifnull(sum(order_total) FILTER (is_valid_for_revenue), 0) AS lifetime_value
  FROM fct_orders WHERE customer_unique_id IS NOT NULL GROUP BY ALL
)
SELECT customer_unique_id, city, state, zip_code_prefix, total_orders, valid_orders,
       first_order_at, last_order_at, lifetime_value,
       {half_up(cents("lifetime_value"), "valid_orders")} AS avg_order_value,
       total_orders > 1 AS is_repeat_customer,
       CASE WHEN lifetime_value <= 0 THEN 'no_valid_orders' WHEN lifetime_value < 200 THEN 'low'
            WHEN lifetime_value < 1000 THEN 'medium' ELSE 'high' END AS value_segment
FROM spending LEFT JOIN latest_location USING (customer_unique_id)"""

CTES["mart_daily_revenue"] = f"""
WITH days AS (
  SELECT order_date, count(*) AS total_orders,
         count(*) FILTER (is_valid_for_revenue) AS valid_orders,
         ifnull(sum(order_total) FILTER (is_valid_for_revenue), 0) AS revenue,
         ifnull(sum(items_value) FILTER (is_valid_for_revenue), 0) AS items_revenue,
         ifnull(sum(freight_value) FILTER (is_valid_for_revenue), 0) AS freight_revenue,
         count(DISTINCT customer_unique_id) FILTER (is_valid_for_revenue) AS unique_customers,
         count(delivered_to_customer_at) AS delivered_orders,
         count(*) FILTER (is_late_delivery) AS late_deliveries
  FROM fct_orders GROUP BY ALL
)
SELECT *, {half_up(cents("revenue"), "valid_orders")} AS avg_order_value,
       {half_up("10000 * late_deliveries", "delivered_orders")} AS late_delivery_pct
FROM days"""

CTES["mart_category_performance"] = f"""
WITH sums AS (
  SELECT ifnull(p.category, 'unknown') AS category, count(*) AS units_sold,
         count(DISTINCT i.order_id) AS orders,
         count(DISTINCT f.customer_unique_id) AS customers,
         sum(i.price) AS items_revenue, sum(i.freight_value) AS freight_revenue,
         sum(i.item_total) AS total_revenue, count(i.price) AS priced
  FROM stg_order_items AS i
  JOIN fct_orders AS f ON f.order_id = i.order_id AND f.is_valid_for_revenue
  LEFT JOIN dim_products AS p ON p.product_id = i.product_id
  GROUP BY 1
), grand AS (SELECT sum(total_revenue) AS everything FROM sums)
SELECT sums.* EXCLUDE (priced), {half_up(cents("items_revenue"), "priced")} AS avg_item_price,
       {half_up("total_revenue * 1000000", "everything * 100")} AS revenue_share_pct,
       rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS revenue_rank
FROM sums, grand"""


def sql(final_select: str) -> str:
    """All relations in front of one final select."""
    body = ",\n".join(f"{name} AS ({text.strip()}\n)" for name, text in CTES.items())
    return f"WITH {body}\n{final_select.strip()}"


def as_double(columns: str) -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in columns.split())


def relation(name: str, money: str = "", drop: str = "") -> str:
    """``SELECT *`` from one relation with its decimals as DOUBLE."""
    exclude = f" EXCLUDE ({', '.join(drop.split())})" if drop else ""
    replace = f" REPLACE ({as_double(money)})" if money else ""
    return sql(f"SELECT *{exclude}{replace} FROM {name}")
