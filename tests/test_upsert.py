import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.upsert import (
    after_mark, delete_insert, newest_after, newest_day_parts, part_of, parts_with, rows_with_keys, write_keyed,
)
from tidemark.plans import item_fact
from tidemark.sources import files

T0 = dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc)


def stamp(**delta):
    return (T0 + dt.timedelta(**delta)).isoformat()


def items(bronze_rows, *rows, table="live_order_items"):
    return bronze_rows(table, *[
        {"order_id": o, "order_item_id": "1", "price": p, "freight_value": "0",
         "_ingested_at": t, "_source_file": f"{o}-{p}"} for o, p, t in rows])


def test_lookback_boundaries(bronze_rows):
    live = items(bronze_rows, ("in", "1", stamp(minutes=-30)), ("edge", "1", stamp(hours=-1)),
                 ("out", "1", stamp(hours=-2)), ("none", "1", None))
    got = item_fact.increment(items(bronze_rows, table="order_items"), live, F.lit(T0))
    assert {r.order_id for r in got.collect()} == {"in"}


def test_no_mark_takes_everything_dated(bronze_rows):
    live = items(bronze_rows, ("a", "1", stamp()), ("none", "1", None))
    no_mark = F.lit(None).cast("timestamp")
    got = item_fact.increment(items(bronze_rows, table="order_items"), live, no_mark)
    assert {r.order_id for r in got.collect()} == {"a"}


def test_filter_before_dedupe_equals_a_full_dedupe(spark):
    rnd = random.Random(3)
    rows = [
        (rnd.randrange(400), rnd.choice([None, 1, 2]),
         None if rnd.random() < 0.05 else T0 + dt.timedelta(minutes=rnd.randrange(6000)), str(n))
        for n in range(5000)
    ]
    copies = spark.createDataFrame(rows, "a int, b int, ingested_at timestamp, source_file string")
    for hours in (0, 50, 99):
        mark = F.lit(T0 + dt.timedelta(hours=hours))
        new = after_mark(F.col("ingested_at"), mark, 1)
        full = latest_per_key(copies, ["a", "b"]).where(new)
        short = newest_after(copies, ["a", "b"], mark)
        assert full.exceptAll(short).isEmpty() and short.exceptAll(full).isEmpty()


def test_delete_insert_leaves_null_keys_alone(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 2), (None, 2)], "k string, v int")
    got = sorted(delete_insert(target, batch, ["k"]).collect(), key=str)
    assert sorted((r.k or "-", r.v) for r in got) == [("-", 1), ("-", 2), ("a", 2), ("b", 1)]


def fact(lake):
    return {(r.order_id, r.order_item_id): str(r.price)
            for r in lake.read("gold", "fct_order_items").collect()}


def test_runs_are_incremental_and_repeatable(lake, bronze_rows):
    history = items(bronze_rows, ("h1", "1", stamp(days=-1)), ("h2", "2", stamp(days=-1)),
                    table="order_items")
    first = items(bronze_rows, ("a", "1", stamp()))
    item_fact.update_item_fact(lake, history, first, "r1", buckets=2)
    assert fact(lake) == {("h1", 1): "1.00", ("h2", 1): "2.00", ("a", 1): "1.00"}

    # a newer copy of a live and of a history row, a row inside and one outside the lookback
    second = first.unionByName(items(
        bronze_rows, ("a", "9", stamp(minutes=5)), ("h1", "9", stamp(minutes=5)),
        ("late", "3", stamp(minutes=-30)), ("lost", "4", stamp(hours=-3))))
    item_fact.update_item_fact(lake, history, second, "r2", buckets=2)
    expected = {("h1", 1): "9.00", ("h2", 1): "2.00", ("a", 1): "9.00", ("late", 1): "3.00"}
    assert fact(lake) == expected
    item_fact.update_item_fact(lake, history, second, "r3", buckets=2)
    assert fact(lake) == expected
    assert lake.read("gold", "fct_order_items").count() == 4


def test_only_touched_parts_are_written(lake, spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    write_keyed(lake, "gold", "t", rows, ["k"], "r1", buckets=8)
    before = {e.part: e.version for e in lake.state("gold", "t").entries}
    write_keyed(lake, "gold", "t", rows.where("k = '7'").withColumn("v", F.lit(2)), ["k"], "r2", 8)
    after = {e.part: e.version for e in lake.state("gold", "t").entries}
    assert len([p for p in after if after[p] != before[p]]) == 1
    got = lake.read("gold", "t")
    assert got.count() == 200 and got.where("v = 2").count() == 1


def test_emptied_part_disappears(lake, spark):
    day = lambda d: F.lit(dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc))
    row = spark.range(1).select(F.lit("k").alias("k"), day(1).alias("at"))
    write_keyed(lake, "gold", "t", row, ["k"], "r1", 2, period="at")
    write_keyed(lake, "gold", "t", row.withColumn("at", day(5)), ["k"], "r2", 2, period="at")
    assert [r.at.day for r in lake.read("gold", "t").collect()] == [5]
    assert len(lake.state("gold", "t").parts) == 1


def test_schema_change_is_refused(lake, spark):
    write_keyed(lake, "gold", "t", spark.range(3).withColumn("v", F.lit(1)), ["id"], "r1", 2)
    with pytest.raises(ValueError, match="w"):
        write_keyed(lake, "gold", "t", spark.range(3).withColumn("w", F.lit(1)), ["id"], "r2", 2)
    with pytest.raises(ValueError, match="v"):
        write_keyed(lake, "gold", "t", spark.range(3).withColumn("v", F.lit("1")), ["id"], "r3", 2)


def test_interrupted_run_changes_nothing(lake, spark, monkeypatch):
    rows = spark.range(20).withColumn("v", F.lit(1))
    write_keyed(lake, "gold", "t", rows, ["id"], "r1", 2)
    with monkeypatch.context() as m:
        m.setattr(lake, "commit", lambda changes: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            write_keyed(lake, "gold", "t", rows.withColumn("v", F.lit(2)), ["id"], "r2", 2)
    assert lake.read("gold", "t").where("v = 2").isEmpty()
    write_keyed(lake, "gold", "t", rows.withColumn("v", F.lit(2)), ["id"], "r2", 2)
    got = lake.read("gold", "t")
    assert got.count() == 20 and got.where("v = 1").isEmpty()


def test_part_names(spark):
    named = spark.createDataFrame([("a", T0), ("a", None)], "k string, at timestamp").select(
        part_of(["k"], 4, F.col("at")).alias("p"))
    parts = [r.p for r in named.collect()]
    assert parts[0].startswith("20240102-0000") and parts[1].startswith("none-0000")


def test_pruning_of_parts():
    parts = {"20240101-00000of00004", "20240102-00001of00004", "none-00001of00004", "20240101-00001of00008"}
    assert parts_with(parts, ["00001of00004"]) == parts - {"20240101-00000of00004"}
    assert newest_day_parts(parts) == {"20240102-00001of00004"}
    assert newest_day_parts({"none-00001of00004"}) == set()


def test_bucket_number_may_change(lake, spark):
    rows = spark.range(50).withColumn("v", F.lit(1))
    write_keyed(lake, "gold", "t", rows, ["id"], "r1", 3)
    write_keyed(lake, "gold", "t", rows.withColumn("v", F.lit(2)).where("id < 10"), ["id"], "r2", 5)
    got = lake.read("gold", "t")
    assert got.count() == 50 and got.where("v = 2").count() == 10


def test_old_loads_are_not_opened(lake, spark):
    day = lambda d: dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc)
    for d in (1, 2):
        lake.commit(lake.stage("bronze", "t", spark.range(d), f"v{d}", "append", loaded_at=day(d)))
    lake.commit(lake.stage("bronze", "t", spark.range(5), "v3", "append"))
    state = lake.state("bronze", "t")
    assert state.read().count() == 8
    assert state.read(newer_than=day(1)).count() == 7
    assert state.read(newer_than=day(2)).count() == 5


def test_large_key_lists_are_not_broadcast(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k"))

    def plan(df):
        return df._jdf.queryExecution().logical().toString()

    assert "Hint broadcast" in plan(broadcast_if_small(keys))
    assert "Hint" not in plan(broadcast_if_small(keys, limit=100))


DAYS = 100


def hundred_days(spark, start=0):
    """One row a day and id; ids of every day interleave, so that no range of keys tells days apart."""
    at = F.timestamp_seconds(F.lit(int(T0.timestamp())) + F.col("id") % DAYS * 86400)
    return spark.range(start, start + 20 * DAYS).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("k"), F.lit(1).alias("line"), at.alias("at"), F.lit(1).alias("v"))


def test_a_returning_key_opens_its_part_only(lake, spark):
    """100 days in 100 parts: the filters leave the one part that holds the key."""
    write_keyed(lake, "gold", "t", hundred_days(spark), ["k", "line"], "r1", 1, period="at")
    state = lake.state("gold", "t")
    assert len(state.parts) == DAYS
    came = hundred_days(spark).where("k = 'o1234'").select("k", "line", F.lit(T0).alias("at"), F.lit(2).alias("v"))
    done = write_keyed(lake, "gold", "t", came, ["k", "line"], "r2", 1, period="at")
    assert done["parts_opened"] <= 4  # its old part, its new one, and what filters let through
    got = lake.read("gold", "t")
    assert got.count() == 20 * DAYS and [r.v for r in got.where("k = 'o1234'").collect()] == [2]
    # keys never seen open the parts they fall into, and few others
    new = hundred_days(spark, 10**6).where("k IN ('o1000005', 'o1000105')")
    assert write_keyed(lake, "gold", "t", new, ["k", "line"], "r3", 1, period="at")["parts_opened"] <= 4
    assert lake.read("gold", "t").count() == 20 * DAYS + 2


def test_lookup_finds_every_stored_key(lake, spark):
    """No key that is there is ruled out, with any number of hash parts, NULL keys and old parts without filters."""
    rows = hundred_days(spark).unionByName(
        spark.createDataFrame([(None, 1, T0, 1), ("x", None, T0, 1)], "k string, line int, at timestamp, v int"))
    write_keyed(lake, "gold", "t", rows, ["k", "line"], "r1", 3, period="at")
    for n, keys in enumerate((rows.where("v = 1"), rows.where("k LIKE 'o1%'"), rows.where("k IS NULL"))):
        wanted = keys.select("k", "line").distinct()
        hits, opened = rows_with_keys(lake.state("gold", "t"), wanted, ["k", "line"])
        found = 0 if hits is None else hits.count()
        assert found == keys.where("k IS NOT NULL AND line IS NOT NULL").count()
        if n == 2:
            assert not opened
    plain = lake.stage("gold", "u", rows.withColumn("part", part_of(["k", "line"], 5, F.col("at"))), "v", "replace", by_part=True)
    lake.commit(plain)
    hits, _ = rows_with_keys(lake.state("gold", "u"), rows.select("k", "line").distinct(), ["k", "line"])
    assert hits.count() == 20 * DAYS


def test_filters_rule_out_what_is_not_there(lake, spark):
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("k"))
    write_keyed(lake, "gold", "t", rows, ["k"], "r1", 1)
    assert lake.state("gold", "t").entries[0].key_blocks > 1
    state = lake.state("gold", "t")
    wrong = sum(
        bool(rows_with_keys(state, spark.createDataFrame([(f"2{i}x",)], "k string"), ["k"])[1]) for i in range(40))
    assert wrong <= 3
    # a key outside the range needs no look at the filter
    assert rows_with_keys(state, spark.createDataFrame([("~",)], "k string"), ["k"])[1] == set()


def test_old_filters_go_with_old_versions(lake, spark):
    rows = spark.range(20).withColumn("v", F.lit(1))
    write_keyed(lake, "gold", "t", rows, ["id"], "r1", 1)
    write_keyed(lake, "gold", "t", rows.withColumn("v", F.lit(2)), ["id"], "r2", 1)
    assert lake.drop_old_versions("gold", "t") == ["version=r1"]
    assert files.child_names(spark, f"{lake.table_path('gold', 't')}/_keys") == ["version=r2"]
    assert write_keyed(lake, "gold", "t", rows.where("id = 3"), ["id"], "r3", 1)["parts"] == 1
    assert lake.read("gold", "t").count() == 20
