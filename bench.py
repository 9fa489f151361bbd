"""Headline queries at one scale, one JSON line.

The layers are built as the pipeline builds them: the driver's tables are written in bronze
shape (``setup_sec``, not part of the total), silver relations are timed from bronze, written once
(``silver_write``), and gold relations are timed from the written silver and order fact. Each
relation is timed in the second of two runs (the first warms the JVM up, as a long-running
cluster is); the ``noop`` sink computes all rows and columns and writes nothing. The two runs
of the incremental fact write, so each happens once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans import gold, item_fact, profile, silver  # noqa: E402
from tidemark.session import local_session, scratch_dir  # noqa: E402
from tidemark.sources import testbed  # noqa: E402
from tidemark.sources.lake import Lake  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name, work) -> None:
        start = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - start, 3)

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    root = scratch_dir(spark, "bench")
    source = testbed.bronze(spark, sf_dir)

    def write_bronze() -> None:
        for name in source:
            # Several files per table, as a table of many loads has.
            source[name].repartition(int(cpus)).write.parquet(f"{root}/bronze/{name}")

    start = time.perf_counter()
    write_bronze()
    setup = round(time.perf_counter() - start, 3)
    bronze = {name: spark.read.parquet(f"{root}/bronze/{name}") for name in source}

    def measure(relations) -> None:
        for build in relations.values():
            consume(build())
        for name, build in relations.items():
            timed(name, lambda: consume(build()))

    measure({name: (lambda build=build: build(bronze)) for name, build in silver.SILVER.items()})

    def write_silver() -> None:
        for name, build in silver.SILVER.items():
            build(bronze).write.parquet(f"{root}/silver/{name}")

    timed("silver_write", write_silver)
    s = {name: spark.read.parquet(f"{root}/silver/{name}") for name in silver.SILVER}

    def fct_orders():
        return gold.fct_orders(
            s["stg_orders"], s["stg_order_items"], s["stg_order_payments"], s["stg_customers"]
        )

    measure({"fct_orders": fct_orders})
    timed("fct_orders_write", lambda: fct_orders().write.parquet(f"{root}/gold/fct_orders"))
    fct = spark.read.parquet(f"{root}/gold/fct_orders")
    measure({
        "dim_customers": lambda: gold.dim_customers(fct, s["stg_customers"]),
        "dim_products": lambda: gold.dim_products(s["stg_products"]),
        "mart_daily_revenue": lambda: gold.mart_daily_revenue(fct),
        "mart_category_performance": lambda: gold.mart_category_performance(
            s["stg_order_items"], fct, gold.dim_products(s["stg_products"])
        ),
        "product_seller_avg_price": lambda: profile.product_seller_avg_price(
            bronze["order_items"]
        ),
        "defect_profile": lambda: profile.defect_profile(
            bronze["orders"].unionByName(bronze["live_orders"]),
            bronze["order_items"].unionByName(bronze["live_order_items"]),
            bronze["order_payments"].unionByName(bronze["live_order_payments"]),
        ),
    })

    lake = Lake(spark, f"{root}/lake")

    hour = F.col("_ingested_at")
    early = bronze["live_order_items"].where(hour < "2024-01-04T20")
    timed("fct_order_items_first_run", lambda: item_fact.update_item_fact(
        lake, bronze["order_items"], early, "r1", buckets=4
    ))
    timed("fct_order_items_increment", lambda: item_fact.update_item_fact(
        lake, bronze["order_items"], bronze["live_order_items"], "r2", buckets=4
    ))
    total = round(sum(timings.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "bronze-to-gold total", "value": total, "unit": "sec",
        "queries": timings, "setup_sec": setup, "sf": float(scale), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
