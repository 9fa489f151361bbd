import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import functions as X


def one(spark, expression, schema, *values):
    df = spark.createDataFrame([tuple(values)], schema)
    return df.select(expression.alias("r")).first().r


@pytest.mark.parametrize("text, expected", [
    ("2024-01-01 10:00:00", dt.datetime(2024, 1, 1, 10)),
    (" 2024-01-01T10:00:00Z ", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00ZZ", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01 10:00:00+05:00", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01", dt.datetime(2024, 1, 1)),
    ("", None), ("Z", None), (" ", None), (None, None),
])
def test_parse_ts(spark, text, expected):
    assert one(spark, X.parse_ts("t"), "t string", text) == expected


def test_parse_ts_rejects_other_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, X.parse_ts("t"), "t string", "yesterday")


@pytest.mark.parametrize("text, expected", [
    ("são-paulo d'oeste", "São-Paulo D'Oeste"), ("RIO de janeiro", "Rio De Janeiro"),
    ("2nd street", "2nd Street"), ("a  b", "A  B"), ("", ""), (None, None),
    ("são josé (dos campos)/sp", "São José (Dos Campos)/Sp"), ("x_y z", "X_Y Z"),
])
def test_initcap_words(spark, text, expected):
    assert one(spark, X.initcap_words("t"), "t string", text) == expected


@pytest.mark.parametrize("text, expected", [("123", "00123"), ("123456", "12345"), (" 7 ", "00007")])
def test_zip5(spark, text, expected):
    assert one(spark, X.zip5("t"), "t string", text) == expected


@pytest.mark.parametrize("text, expected", [
    ("-12.50", Decimal("-12.50")), (" 1.005 ", Decimal("1.01")), ("-1.005", Decimal("-1.01")),
    ("", None), ("  ", None), ("1e3", Decimal("1000.00")),
])
def test_money(spark, text, expected):
    assert one(spark, X.money("t"), "t string", text) == expected


@pytest.mark.parametrize("text", ["abc", "99999999999.99"])
def test_money_rejects_bad_numbers(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        one(spark, X.money("t"), "t string", text)


@pytest.mark.parametrize("text", ["x", "1.0"])
def test_whole_number_rejects_bad_numbers(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, X.whole_number("t"), "t string", text)


def test_ratio_rounds_once(spark):
    # The mean is 1.0049996: 1.00, not 1.01 by way of 1.005.
    n, d = Decimal("25124.99"), 25000
    assert one(spark, X.ratio(F.col("n"), F.col("d")), "n decimal(22,2), d long", n, d) == Decimal("1.00")
    assert one(spark, X.ratio(F.col("n"), F.col("d")), "n decimal(22,2), d long", n, 0) is None
    half = X.ratio(F.col("n"), F.col("d"))
    assert one(spark, half, "n decimal(22,2), d long", Decimal("-2.01"), 2) == Decimal("-1.01")


def test_days_between(spark):
    start = dt.datetime(2024, 1, 1)
    days = X.days_between("a", "b")
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert one(spark, days, schema, start, start + dt.timedelta(seconds=90_720)) == Decimal("1.1")
    assert one(spark, days, schema, start, start - dt.timedelta(seconds=90_720)) == Decimal("-1.1")
