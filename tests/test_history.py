import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import history

CHECK = ["zip", "city"]


def at(day):
    return F.lit(dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc))


def state(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, zip string, city string, note string")


STATES = (
    [("same", "1", "A", "x"), ("moved", "1", "A", "x"), ("filled", None, "A", "x"),
     ("gone", "1", "A", "x")],
    [("same", "1", "A", "y"), ("moved", "1", "B", "y"), ("filled", "2", "A", "y"),
     ("new", "1", "A", "y")],
    [("same", "1", "A", "z"), ("moved", "1", "A", "z"), ("filled", "2", "A", "z"),
     ("new", "1", "A", "z")],
)


def summary(df):
    def day(t):
        return None if t is None else t.day
    return sorted(
        ((r.id, r.zip, r.city, r.note, day(r.valid_from), day(r.valid_to)) for r in df.collect()),
        key=str)


EXPECTED = sorted([
    ("same", "1", "A", "x", 1, None),
    ("moved", "1", "A", "x", 1, 2), ("moved", "1", "B", "y", 2, 3), ("moved", "1", "A", "z", 3, None),
    ("filled", None, "A", "x", 1, 2), ("filled", "2", "A", "y", 2, None),
    ("gone", "1", "A", "x", 1, None),
    ("new", "1", "A", "y", 2, None),
], key=str)


def test_three_states(spark):
    versions = None
    for day, rows in enumerate(STATES, 1):
        versions = history.snapshot_check(versions, state(spark, *rows), "id", CHECK, at(day))
    assert summary(versions) == EXPECTED
    assert versions.select("scd_id").distinct().count() == len(EXPECTED)
    seen = history.valid_at(versions, at(2)).collect()
    assert {(r.id, r.city, r.zip) for r in seen} == {
        ("same", "A", "1"), ("moved", "B", "1"), ("filled", "A", "2"), ("gone", "A", "1"),
        ("new", "A", "1")}


def test_stored_history(lake, spark):
    counts = [
        history.update_history(lake, "h", state(spark, *rows), "id", CHECK, at(day), f"r{day}")
        for day, rows in enumerate(STATES, 1)
    ]
    assert [c["closed"] for c in counts] == [0, 2, 1]
    stored = history.read_history(lake, "h")
    assert summary(stored) == EXPECTED
    lake.publish(["snapshots"])
    history.publish_history(lake, "h")
    assert summary(spark.table("snapshots.h")) == EXPECTED
    spark.sql("DROP DATABASE snapshots CASCADE")
    open_rows = stored.where("valid_to IS NULL").groupBy("id").count()
    assert open_rows.where("count > 1").isEmpty()


def test_unchanged_state_changes_nothing(lake, spark):
    for day in (1, 2):
        history.update_history(
            lake, "h", state(spark, *STATES[0]), "id", CHECK, at(day), f"r{day}")
    assert {r[4:] for r in summary(history.read_history(lake, "h"))} == {(1, None)}


def moments(spark, rows):
    return spark.createDataFrame(rows, "n long, id string, at timestamp")


def in_january(hours):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hours)


def by_range(facts, versions):
    """The plain form: a range condition for each pair."""
    on = (facts.id == versions.id) & (versions.valid_from <= facts.at) & (
        versions.valid_to.isNull() | (versions.valid_to > facts.at))
    return facts.join(versions, on, "left").select(facts.n, facts.id, facts.at, versions.city, versions.zip)


def test_as_of_join_equals_the_range_join(spark):
    """Hot key with a third of all facts and many versions, equal moments, boundaries, gaps, NULLs, unknown keys."""
    rnd = random.Random(4)
    versions = []
    for key in ("hot", "a", "b", "late"):
        start = 300 if key == "late" else rnd.randrange(10)
        while start < 600:
            end = start + rnd.randrange(1, 40)
            last = end >= 600 and key != "b"
            versions.append((key, f"{key}{start}", None if start % 3 == 0 else str(start),
                             in_january(start), None if last else in_january(end)))
            start = end + (rnd.randrange(5) if rnd.random() < 0.2 else 0)
    history_ = spark.createDataFrame(versions, "id string, city string, zip string, valid_from timestamp, valid_to timestamp")
    edges = [v[3] for v in versions] + [v[4] for v in versions if v[4]]
    facts = []
    for n in range(3000):
        key = "hot" if n % 3 == 0 else rnd.choice(["a", "b", "late", "none", None])
        at = in_january(77) if n % 6 == 0 else rnd.choice([in_january(rnd.uniform(-20, 700)), rnd.choice(edges), None])
        facts.append((n, key, at))
    df = moments(spark, facts).repartition(5)
    want = sorted(map(tuple, by_range(df, history_).collect()), key=str)
    for share, slices in ((256, 8), (2, 64), (1, 4), (10**9, 4)):
        got = history.as_of_join(df, history_, "id", "at", ["city", "zip"], hot_share=share, slices=slices)
        assert sorted(map(tuple, got.select("n", "id", "at", "city", "zip").collect()), key=str) == want
    plan = history.as_of_join(df, history_, "id", "at", ["city", "zip"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert history.as_of_join(df.limit(0), history_, "id", "at", ["city", "zip"]).count() == 0
    assert history.as_of_join(df, history_.limit(0), "id", "at", ["city"]).where("city IS NULL").count() == 3000


def test_as_of_join_cuts_a_hot_key(spark):
    """A key with a third of the facts, half of those at one moment: no window group holds over a twentieth of the facts."""
    df = moments(spark, [(n, "hot" if n % 3 == 0 else f"k{n}", in_january(5 if n % 6 == 0 else n / 10)) for n in range(12000)])
    versions = spark.createDataFrame(
        [("hot", str(h), in_january(h), in_january(h + 24)) for h in range(0, 1200, 24)],
        "id string, city string, valid_from timestamp, valid_to timestamp")
    joined = history.as_of_join(df, versions, "id", "at", ["city"], slices=32)
    assert joined.where("id = 'hot' AND city IS NULL").count() == 0
    cut = history.time_slices(df.select(F.col("id").alias("_key"), F.col("at").alias("_at"), F.struct("n").alias("_fact")), 256, 32)
    sizes = cut[0].groupBy("_key", "_slice").count().agg(F.max("count")).first()[0]
    assert sizes <= 600
