"""Every registered query against its SQL, on the smallest scale."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
import registered

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    assert not isinstance(value, decimal.Decimal)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in records), key=str)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows(df.columns, df.collect()) == rows(relation.columns, relation.fetchall())


def test_every_query_has_sql():
    assert set(registered.QUERIES) == set(registered.ORACLES)
    assert set(registered.QUERIES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "order_date" and df.count() > 0
