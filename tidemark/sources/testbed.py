"""The driver's TPC-H-like tables in bronze shape: all text, defects included.

Every rule depends on keys only, so the same relation can be written in SQL. All rows of the
source tables take part: the key arithmetic decides *which* defect or which side (history or
live) a row gets, never whether it is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

HISTORY_TIME = "2024-01-01T00:00:00+00:00"
LIVE_START = "2024-01-02 00:00:00"


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _live_time(hours: Column) -> Column:
    instant = F.to_timestamp_ntz(F.lit(LIVE_START)) + F.make_dt_interval(hours=hours.cast("int"))
    return F.concat(F.translate(_text(instant), " ", "T"), F.lit("+00:00"))


_schemas: dict[str, StructType] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table; its schema is read from the file footer once per process."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _plus_days(ts: str, days: Column | int) -> Column:
    number = F.lit(days) if isinstance(days, int) else days
    return F.col(ts) + F.make_dt_interval(days=number.cast("int"))


def all_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order once, with the columns both sides need."""
    k = F.col("o_orderkey")
    state = (
        F.when(_every("o_orderkey", 53), "canceled")
        .when(_every("o_orderkey", 59), "unavailable")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    bought = F.col("o_orderdate") + F.make_dt_interval(secs=(k % 86400).cast("decimal(18,6)"))
    bought_text = (
        F.when(_every("o_orderkey", 13), F.concat(F.translate(_text(bought), " ", "T"), F.lit("Z")))
        .otherwise(_text(bought))
    )
    arrived = (state == "delivered") & ~_every("o_orderkey", 97)
    return _read(spark, sf_dir, "orders").select(
        k.alias("k"),
        _text(k).alias("order_id"),
        F.when(_every("o_orderkey", 47), "").otherwise(F.concat(F.lit("c"), _text(k))).alias("customer_id"),
        F.when(_every("o_orderkey", 11), F.concat(F.lit(" "), F.upper(state), F.lit(" ")))
        .otherwise(state)
        .alias("order_status"),
        bought_text.alias("order_purchase_timestamp"),
        F.when(_every("o_orderkey", 5), "").otherwise(bought_text).alias("order_approved_at"),
        F.when(arrived, _text(_plus_days("o_orderdate", 1))).alias("order_delivered_carrier_date"),
        F.when(arrived, _text(_plus_days("o_orderdate", k % 30 + 1))).alias(
            "order_delivered_customer_date"
        ),
        _text(_plus_days("o_orderdate", 20)).alias("order_estimated_delivery_date"),
    )


def _history_side(df: DataFrame, file_name: str) -> DataFrame:
    return df.withColumns({
        "_ingested_at": F.lit(HISTORY_TIME),
        "_source_file": F.lit(file_name),
        "_batch_id": F.lit("history"),
    })


def _live_side(df: DataFrame, folder: str) -> DataFrame:
    hour = F.col("k") % 72
    return df.withColumns({
        "_ingested_at": _live_time(hour),
        "_source_file": F.concat(F.lit(f"{folder}/{folder}_"), _text(hour), F.lit(".jsonl")),
        "_batch_id": F.concat(F.lit("live-"), _text(hour)),
    })


def orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(history, live). Every fortieth order was also in the history, still ``created``."""
    every = all_orders(spark, sf_dir)
    redelivered = _every("k", 40)
    history = (
        every.where(~_every("k", 10) | redelivered)
        .withColumn("order_status", F.when(redelivered, "created").otherwise(F.col("order_status")))
    )
    return (
        _history_side(history, "orders.csv").drop("k"),
        _live_side(every.where(_every("k", 10)), "orders").drop("k"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(history, live). (order, line) repeats in lineitem: natural duplicates."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long") % 20000
    price = F.concat(
        F.when(_every("l_orderkey", 71) & (F.col("l_linenumber") == 1), "-").otherwise(""),
        _text(((cents - cents % 100) / 100).cast("long")),
        F.lit("."),
        F.lpad(_text(cents % 100), 2, "0"),
    )
    every = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_partkey").alias("part"),
        _text("l_orderkey").alias("order_id"),
        _text("l_linenumber").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        _text("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        _text("l_quantity").alias("freight_value"),
        F.concat(
            F.lit("items_"), F.lpad(_text("l_partkey"), 10, "0"),
            F.lit("_"), F.lpad(_text("l_suppkey"), 10, "0"),
            F.lit("_"), _text("l_quantity"), F.lit("_"), _text("l_extendedprice"),
        ).alias("_source_file"),
    )
    history = every.where(~_every("k", 10)).withColumns({
        "_ingested_at": F.lit(HISTORY_TIME),
        "_batch_id": F.lit("history"),
    })
    hour = F.col("part") % 72
    live = every.where(_every("k", 10)).withColumns({
        "_ingested_at": _live_time(hour),
        "_batch_id": F.concat(F.lit("live-"), _text(hour)),
    })
    return history.drop("k", "part"), live.drop("k", "part")


def order_payments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(history, live). One payment per order, and a voucher on every seventh. Every fortieth
    order's payments were also in the history, with another amount and type."""
    priority = F.substring("o_orderpriority", 1, 1)
    kind = (
        F.when(_every("k", 61), "UPI")
        .when(priority == "1", "credit_card")
        .when(priority == "2", " Boleto")
        .when(priority == "3", "voucher")
        .when(priority == "4", "not_defined")
        .otherwise("debit_card")
    )
    main = F.struct(
        F.lit("1").alias("payment_sequential"),
        kind.alias("payment_type"),
        _text(F.col("k") % 10 + 1).alias("payment_installments"),
        _text(F.col("o_totalprice").cast("decimal(14,2)")).alias("payment_value"),
    )
    extra = F.struct(
        F.lit("2").alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit("1").alias("payment_installments"),
        F.lit("10.00").alias("payment_value"),
    )
    payments = F.when(_every("k", 7), F.array(main, extra)).otherwise(F.array(main))
    every = (
        _read(spark, sf_dir, "orders")
        .withColumnRenamed("o_orderkey", "k")
        .select("k", _text("k").alias("order_id"), F.explode(payments).alias("p"))
        .select("k", "order_id", "p.*")
    )
    redelivered = _every("k", 40)
    history = every.where(~_every("k", 10) | redelivered).withColumns({
        "payment_type": F.when(redelivered, "boleto").otherwise(F.col("payment_type")),
        "payment_value": F.when(redelivered, "1.00").otherwise(F.col("payment_value")),
    })
    return (
        _history_side(history, "order_payments.csv").drop("k"),
        _live_side(every.where(_every("k", 10)), "order_payments").drop("k"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the id is issued per order, the person spans several."""
    k = F.col("o_orderkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    people = _read(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = _read(spark, sf_dir, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select(
        F.concat(F.lit("c"), _text(k)).alias("customer_id"),
        F.when(_every("o_orderkey", 5), F.concat(F.lit("s"), _text(k)))
        .otherwise(F.concat(F.lit("p"), _text(((k - k % 4) / 4).cast("long"))))
        .alias("customer_unique_id"),
        _text(F.col("c_custkey") % 100000).alias("customer_zip_code_prefix"),
        F.concat(
            F.lit(" "), F.lower("n_name"), F.lit("-d'este "), F.lower("c_mktsegment"), F.lit(" ")
        ).alias("customer_city"),
        F.concat(F.lit("n"), _text("c_nationkey")).alias("customer_state"),
    )
    return _history_side(rows, "customers.csv")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    rows = _read(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.when(~_every("p_partkey", 83), F.col("p_name")).alias("product_category_name"),
        _text(F.length("p_name")).alias("product_name_lenght"),
        _text(F.length("p_type")).alias("product_description_lenght"),
        _text(size % 5).alias("product_photos_qty"),
        F.when(~_every("p_partkey", 37), _text(size * 100)).alias("product_weight_g"),
        _text(size).alias("product_length_cm"),
        _text(size % 7 + 1).alias("product_height_cm"),
        _text(size % 11 + 1).alias("product_width_cm"),
    )
    return _history_side(rows, "products.csv")


def translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _read(spark, sf_dir, "part").select("p_name").distinct()
    rows = names.where(F.length("p_name") % 5 != 0).select(
        F.col("p_name").alias("product_category_name"),
        F.upper("p_name").alias("product_category_name_english"),
    )
    return _history_side(rows, "translation.csv")


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = (
        _read(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _text("s_suppkey").alias("seller_id"),
            _text(F.col("s_suppkey") * 37).alias("seller_zip_code_prefix"),
            F.concat(F.lit("  porto/"), F.lower("n_name"), F.lit(" ")).alias("seller_city"),
            F.concat(F.lit(" n"), _text("s_nationkey")).alias("seller_state"),
        )
    )
    return _history_side(rows, "sellers.csv")


class Bronze(Mapping):
    """The ten declared bronze tables over one scale directory, each built when asked for."""

    _PAIRS = {
        "orders": (orders, 0), "live_orders": (orders, 1),
        "order_items": (order_items, 0), "live_order_items": (order_items, 1),
        "order_payments": (order_payments, 0), "live_order_payments": (order_payments, 1),
    }
    _SINGLES = {
        "customers": customers,
        "products": products,
        "product_category_translation": translations,
        "sellers": sellers,
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._PAIRS:
            build, side = self._PAIRS[name]
            return build(self._spark, self._sf_dir)[side]
        return self._SINGLES[name](self._spark, self._sf_dir)

    def __iter__(self) -> Iterator[str]:
        return iter([*self._PAIRS, *self._SINGLES])

    def __len__(self) -> int:
        return len(self._PAIRS) + len(self._SINGLES)


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(spark, sf_dir)
