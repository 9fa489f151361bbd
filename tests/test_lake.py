import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.upsert import write_keyed
from tidemark.sources import files
from tidemark.sources import lake as lake_module


def test_commit_covers_several_tables(lake, spark):
    a = lake.stage("gold", "a", spark.range(2), "v1", "replace")
    b = lake.stage("gold", "b", spark.range(3), "v1", "replace")
    assert not lake.state("gold", "a").exists and not lake.state("gold", "b").exists
    lake.commit([*a, *b])
    assert lake.read("gold", "a").count() == 2 and lake.read("gold", "b").count() == 3
    assert lake.row_counts("gold") == {"a": 2, "b": 3}


def test_append_then_replace(lake, spark):
    for n in (1, 2):
        lake.commit(lake.stage("bronze", "t", spark.range(n), f"v{n}", "append"))
    assert lake.read("bronze", "t").count() == 3
    lake.replace("bronze", "t", spark.range(10), "v3")
    assert lake.read("bronze", "t").count() == 10
    lake.commit(lake.stage("bronze", "t", spark.range(1), "v4", "append"))
    assert lake.read("bronze", "t").count() == 11
    assert lake.state("bronze", "t").versions == ["v3", "v4"]


def test_compaction_keeps_rows_and_load_time(lake, spark):
    day = lambda d: dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc)
    for d in (1, 2, 3):
        lake.commit(lake.stage("bronze", "t", spark.range(d), f"v{d}", "append", loaded_at=day(d)))
    assert lake.compact("bronze", "t", "all") == 6
    state = lake.state("bronze", "t")
    assert state.versions == ["all"] and state.read().count() == 6
    assert state.read(newer_than=day(2)).count() == 6
    assert state.read(newer_than=day(3)).count() == 0


def test_missing_table(lake, spark):
    with pytest.raises(FileNotFoundError):
        lake.read("gold", "nothing")
    assert lake.read("gold", "nothing", spark.range(1).schema).count() == 0


def test_tables_can_be_named_in_sql(lake, spark):
    lake.replace("gold", "plain", spark.range(4), "v1")
    rows = spark.range(50).withColumn("v", F.lit(1))
    write_keyed(lake, "gold", "keyed", rows, ["id"], "r1", 4)
    write_keyed(lake, "gold", "keyed", rows.where("id < 2").withColumn("v", F.lit(2)), ["id"], "r2", 4)
    assert lake.publish() == ["gold.keyed", "gold.plain"]
    assert spark.sql("SELECT count(*) AS n FROM gold.plain").first().n == 4
    r = spark.sql("SELECT count(*) AS n, count(DISTINCT id) AS d, sum(v) AS s FROM gold.keyed").first()
    assert (r.n, r.d, r.s) == (50, 50, 52)
    lake.replace("gold", "plain", spark.range(5), "v2")
    lake.publish()
    assert spark.sql("SELECT count(*) AS n FROM gold.plain").first().n == 5
    spark.sql("DROP DATABASE gold CASCADE")


def test_layers_are_made(lake):
    import os

    lake.create_layers()
    lake.create_layers()
    assert {"bronze", "silver", "gold", "audit", "snapshots"} <= set(os.listdir(lake.root))


def folders(lake):
    return [name for _, name in lake._log_folders()]


def test_log_is_folded(lake, spark, monkeypatch):
    """Snapshots leave what is live and the names of all versions; readers open few folders, however many commits."""
    monkeypatch.setattr(lake_module, "FOLD", 4)
    monkeypatch.setattr(lake_module, "RECENT", 2)
    for n in range(9):
        lake.replace("gold", "a", spark.range(n), f"a{n}")
        lake.commit(lake.stage("bronze", "b", spark.range(1), f"b{n}", "append"))
        if n == 6:
            lake.replace("bronze", "b", spark.range(5), "b-all")
        assert len(folders(lake)) <= 4 + 2 + 2
    assert folders(lake)[0].startswith("snapshot")
    assert lake.read("gold", "a").count() == 8 and lake.read("bronze", "b").count() == 5 + 2
    assert lake.row_counts("gold") == {"a": 8}
    assert lake.committed_versions("gold", "a") == {f"a{n}" for n in range(9)}
    assert lake.committed_versions("bronze", "b") == {f"b{n}" for n in range(9)} | {"b-all"}
    with pytest.raises(ValueError, match="already committed"):
        lake.stage("gold", "a", spark.range(1), "a0", "replace")
    stored = files.child_names(spark, f"{lake.root}/commit_log")
    assert sum(n.startswith("snapshot") for n in stored) <= 2 and len(stored) <= 2 * (4 + 2) + 2


def test_death_while_folding(lake, spark, monkeypatch):
    """A snapshot that is not whole is not read, and the next commit folds again."""
    monkeypatch.setattr(lake_module, "FOLD", 3)
    monkeypatch.setattr(lake_module, "RECENT", 1)
    with monkeypatch.context() as m:
        m.setattr(files, "move", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        for n in range(7):
            try:
                lake.replace("gold", "a", spark.range(n), f"a{n}")
            except OSError:
                pass
    assert not folders(lake)[0].startswith("snapshot") and lake.read("gold", "a").count() == 6
    write_keyed(lake, "gold", "k", spark.range(10), ["id"], "r1", 2)
    write_keyed(lake, "gold", "k", spark.range(5, 6), ["id"], "r2", 2)
    assert folders(lake)[0].startswith("snapshot")
    assert lake.read("gold", "a").count() == 6 and lake.read("gold", "k").count() == 10
    write_keyed(lake, "gold", "k", spark.range(7, 8), ["id"], "r3", 2)
    assert lake.read("gold", "k").count() == 10


def test_changed_cell_is_refused(lake, spark, monkeypatch):
    """Equal row counts are not enough: the stored copy has the hashes of the rows that were read."""
    rows = spark.range(50).withColumn("v", F.col("id").cast("string"))
    assert lake.replace("bronze", "t", rows, "v1", by_content=True) == 50
    assert lake.replace("bronze", "t", rows.limit(0), "v2", by_content=True) == 0
    nulls = rows.withColumn("w", F.when(F.col("id") % 2 == 0, F.lit(1.5)))
    assert lake.replace("bronze", "t", nulls.unionByName(nulls), "v3", by_content=True) == 100
    reader = type(spark.read)
    plain = reader.parquet

    def changed(self, *paths, **options):
        df = plain(self, *paths, **options)
        return df.withColumn("v", F.when(F.col("id") == 7, "other").otherwise(F.col("v"))) if "v" in df.columns else df

    with monkeypatch.context() as m:
        m.setattr(reader, "parquet", changed)
        with pytest.raises(ValueError, match="differ"):
            lake.replace("bronze", "t", rows, "v4", by_content=True)
    assert lake.read("bronze", "t").count() == 100
