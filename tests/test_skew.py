"""Plans under skew: one key owns a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import heavy_keys, inner_join_spread, left_join_spread_nulls
from tidemark.operators.latest import latest_per_key

ROWS = 120_000


@pytest.fixture
def shuffled(spark):
    """Force shuffles, many partitions and a low bar for calling a partition skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_per_partition(df):
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("payload"))
    return [r.n for r in sizes.collect()]


def test_copies_of_a_hot_key_are_cut_before_the_shuffle(shuffled):
    df = shuffled.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds("id").alias("ingested_at"),
        F.col("id").cast("string").alias("source_file"),
    )
    latest = latest_per_key(df, ["k"])
    assert latest.count() == ROWS * 2 // 3 + 1
    plan = executed(latest)
    assert re.search(r"WindowGroupLimit .* Final[\s\S]*Exchange hashpartitioning[\s\S]*Partial", plan)
    hot = latest.where("k = 'hot'").first()
    assert hot.source_file == str(ROWS - 3)


def orders(spark, key):
    return spark.range(0, ROWS, 1, 8).select(
        F.col("id").cast("string").alias("order_id"), key.alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def customers(spark):
    return spark.range(ROWS).select(
        F.col("id").cast("string").alias("customer_id"), F.lit("p").alias("person")
    )


def test_null_keys_are_spread(shuffled):
    key = F.when(F.col("id") % 3 != 0, F.col("id").cast("string"))
    joined = left_join_spread_nulls(
        orders(shuffled, key), customers(shuffled), "customer_id", "order_id"
    )
    sizes = rows_per_partition(joined)
    assert sum(sizes) == ROWS and max(sizes) < 2 * ROWS / 16
    assert joined.where("customer_id IS NULL AND person IS NOT NULL").isEmpty()
    assert joined.where("person IS NULL").count() == ROWS // 3


def test_hot_join_key_is_split(shuffled):
    key = F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string"))
    joined = left_join_spread_nulls(
        orders(shuffled, key), customers(shuffled), "customer_id", "order_id"
    )
    sizes = rows_per_partition(joined)
    assert sum(sizes) == ROWS and max(sizes) < ROWS / 6


def test_heavy_keys_are_found_in_one_pass(shuffled):
    rows = shuffled.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").when(F.col("id") % 7 != 0, F.col("id").cast("string"))
        .alias("k"))
    assert heavy_keys(rows, "k") == ["hot", "warm"]
    assert heavy_keys(rows, "k", share=10) == ["hot"]
    assert heavy_keys(rows.where("k IS NULL"), "k") == [] and heavy_keys(rows.limit(0), "k") == []
    plan = executed(rows.agg(F.expr("approx_top_k(k, 10, 1000)")))
    assert "hashpartitioning" not in plan


def test_hot_keys_are_salted_without_adaptive_execution(shuffled):
    """A customer with a third of all orders, adaptive execution off: no task has twice the median."""
    shuffled.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        key = F.when(F.col("id") % 3 == 0, "7").when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
        left, right = orders(shuffled, key), customers(shuffled)
        hot = heavy_keys(left, "customer_id")
        assert hot == ["7"]
        joined = left_join_spread_nulls(left, right, "customer_id", "order_id", hot)
        sizes = sorted(rows_per_partition(joined))
        assert sum(sizes) == ROWS and sizes[-1] < 2 * sizes[len(sizes) // 2]
        plain = left_join_spread_nulls(left, right, "customer_id", "order_id")
        assert joined.columns == plain.columns and joined.exceptAll(plain).isEmpty()
        inner = inner_join_spread(left, right, "customer_id", ["order_id"], hot)
        sizes = sorted(rows_per_partition(inner))
        assert sizes[-1] < 2 * sizes[len(sizes) // 2]
        want = left.join(right, "customer_id")
        assert sum(sizes) == want.count() and inner.select(want.columns).exceptAll(want).isEmpty()
    finally:
        shuffled.conf.set("spark.sql.adaptive.enabled", "true")
