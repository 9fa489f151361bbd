import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.sample import sample_rows
from tidemark.operators.upsert import part_of
from tidemark.plans import checks, profile


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1, True), ("a", 1, False), ("b", 2, None), (None, 2, True), (None, 2, False)],
        "k string, n int, flag boolean")


def test_failing_rows(spark, table):
    assert [tuple(r) for r in quality.unique(table, "k").collect()] == [("a", 2)]
    assert quality.not_null(table, "k").count() == 2
    assert quality.not_flagged(table, "flag").count() == 2
    bad = quality.accepted_values(table, "k", ["b"]).collect()
    assert [tuple(r) for r in bad] == [("a", 2)]
    pairs = {(r.k, r.n): r.duplicate_count for r in quality.unique_combination(table, ["k", "n"]).collect()}
    assert pairs == {("a", 1): 2, (None, 2): 2}
    parent = spark.createDataFrame([("b",), ("b",)], "id string")
    assert [tuple(r) for r in quality.relationships(table, "k", parent, "id").collect()] == [("a", 2)]


def suite(table, severity):
    s = quality.Suite({"t": table})
    s.not_null("t", "k")
    s.not_null("t", "n")
    s.not_flagged("t", "flag", severity)
    s.unique("t", "k")
    s.unique_combination("t", ["k", "n"])
    s.accepted_values("t", "k", ["a", "b"])
    s.relationships("t", "k", "t", "k")
    return s


def test_report_and_severity(table):
    got = {r.check: (r.severity, r.failures, r.status)
           for r in quality.report(suite(table, quality.WARN)).collect()}
    assert got == {
        "not_null_t_k": ("error", 2, "fail"), "not_null_t_n": ("error", 0, "pass"),
        "not_flagged_t_flag": ("warn", 2, "warn"), "unique_t_k": ("error", 1, "fail"),
        "unique_combination_t_k_n": ("error", 2, "fail"),
        "accepted_values_t_k": ("error", 0, "pass"), "relationships_t_k_t": ("error", 0, "pass"),
    }


def test_failures_are_kept_and_cleared(lake, table):
    with pytest.raises(quality.ChecksFailed, match="not_null_t_k"):
        quality.run_checks(suite(table, quality.WARN), lake, "r1")
    assert lake.read("audit", "not_null_t_k").count() == 2
    assert lake.read("audit", "not_null_t_n").count() == 0
    clean = table.where("k = 'b'")
    result = quality.run_checks(suite(clean, quality.WARN), lake, "r2")
    assert {r.status for r in result.collect()} == {"pass"}
    assert lake.read("audit", "not_null_t_k").count() == 0


def test_warnings_do_not_raise(table):
    s = quality.Suite({"t": table})
    s.not_flagged("t", "flag")
    assert quality.run_checks(s).first().status == "warn"


def test_number_of_checks():
    assert sum(map(len, (
        checks.NOT_NULL, checks.UNIQUE, checks.UNIQUE_COMBINATION, checks.RELATIONSHIPS,
        checks.NOT_FLAGGED, checks.ACCEPTED_VALUES))) == 39


def test_relationships_counts_rows_not_values(spark):
    child = spark.createDataFrame([("x",)] * 5 + [("y",)], "k string")
    s = quality.Suite({"c": child, "p": spark.createDataFrame([("y",)], "id string")})
    s.relationships("c", "k", "p", "id")
    assert quality.report(s).first().failures == 5


def test_defect_profile(bronze_rows):
    orders = bronze_rows(
        "orders",
        {"order_id": "1", "customer_id": "c", "order_status": "created"},
        {"order_id": "1", "customer_id": "c", "order_status": "created"},
        {"order_id": "1", "customer_id": "c", "order_status": " CREATED "},
        {"order_id": "2", "customer_id": " ", "order_purchase_timestamp": "2024-01-01T00:00:00Z"})
    items = bronze_rows("order_items", {"price": "-1"}, {"price": ""}, {"price": "2.5"})
    payments = bronze_rows("order_payments", {"payment_type": "UPI"}, {"payment_type": " Boleto"})
    got = {r.issue: r.row_count for r in profile.defect_profile(orders, items, payments).collect()}
    assert got == {"duplicate_order": 2, "missing_customer": 1, "messy_status": 1,
                   "iso_timestamp": 1, "negative_price": 1, "unknown_payment_type": 1}


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    first = {r.id for r in sample_rows(df, ["id"], 50, seed=1).collect()}
    again = {r.id for r in sample_rows(df.repartition(7), ["id"], 50, seed=1).collect()}
    other = {r.id for r in sample_rows(df, ["id"], 50, seed=2).collect()}
    assert len(first) == 50 and first == again and first != other


def dated(spark, days, keys):
    at = F.make_timestamp(F.lit(2024), F.lit(1), F.col("d"), F.lit(0), F.lit(0), F.lit(0))
    return spark.createDataFrame([(k, d) for k in keys for d in days], "k string, d int").select(
        "k", "d", at.alias("at"), part_of(["k"], 1, at).alias("part"))


def test_duplicates_across_an_old_and_a_new_part(lake, spark):
    """Thirty days are there; a load of the next one repeats a key of its own and one of day 7: only that day is opened."""
    old = dated(spark, range(1, 31), [f"n{n}" for n in range(20)])
    old = old.withColumn("k", F.concat(F.lit("k"), "d", F.lit("-"), F.substring("k", 2, 9))).select(
        "k", "at", part_of(["k"], 1, F.col("at")).alias("part"))
    lake.commit(lake.stage("gold", "t", old, "old", "replace", by_part=True, keys=["k"]))
    fresh = dated(spark, [31], ["k31-1", "k31-1", "k7-3", "k31-2"]).drop("d")
    lake.commit(lake.stage("gold", "t", fresh, "new", "append", by_part=True, keys=["k"]))
    found, opened = quality.duplicates_since(lake, "gold", "t", ["k"], "new")
    assert sorted(map(tuple, found.collect())) == [("k31-1", 2), ("k7-3", 2)] and opened <= 3
    whole = quality.unique_combination(lake.read("gold", "t"), ["k"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, found.collect()))
    assert quality.duplicates_since(lake, "gold", "t", ["k"], "none")[0].count() == 0


def test_failing_rows_are_computed_once(lake, spark):
    """Rows of a check that is a query are written once and counted there."""
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows = spark.range(10).repartition(1).mapInArrow(seen, "id long")
    suite = quality.Suite({"t": spark.range(3)})
    suite.query("some_rows", rows)
    suite.not_null("t", "id")
    result = {r.check: (r.failures, r.status) for r in quality.run_checks(suite, lake, "r1", raise_on_error=False).collect()}
    assert result == {"some_rows": (10, "fail"), "not_null_t_id": (0, "pass")}
    assert calls.value == 10 and lake.read("audit", "some_rows").count() == 10
