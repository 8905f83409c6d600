import datetime as dt

import pytest
from pyspark.sql import functions as F

from kabuto.functions.columns import (
    DASH_DATETIME,
    SLASH_DATETIME,
    add_months_back,
    money_sum,
    parse_datetime,
    prev_weekday,
    safe_divide,
    try_parse_datetime,
    valuation_date,
)
from tests.conftest import D


def test_prev_weekday_every_day(spark):
    # 2024-01-22 is a Monday; the week runs to Sunday 2024-01-28.
    days = [D("2024-01-22") + dt.timedelta(days=i) for i in range(7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = dict(df.select("d", prev_weekday("d").alias("p")).collect())
    fri = D("2024-01-26")
    assert got == {d: (fri if d.weekday() >= 5 else d) for d in days}


def test_valuation_date_flag_semantics(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    sunday = D("2024-01-28")
    got = {r["f"]: r["v"] for r in df.select("f", valuation_date(sunday, "f").alias("v")).collect()}
    # IF(flag, d, prev_weekday(d)): a NULL flag takes the weekday branch.
    assert got == {True: sunday, False: D("2024-01-26"), None: D("2024-01-26")}


def test_parse_datetime_lenient_padding_strict_garbage(spark):
    df = spark.createDataFrame([("2025/9/5 1:02:03",), ("2025/09/05 01:02:03",)], "s string")
    got = [r[0] for r in df.select(parse_datetime("s", SLASH_DATETIME)).collect()]
    assert got == [dt.datetime(2025, 9, 5, 1, 2, 3)] * 2
    bad = spark.createDataFrame([("not a time",)], "s string")
    with pytest.raises(Exception):
        bad.select(parse_datetime("s", DASH_DATETIME)).collect()


def test_try_parse_datetime(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("garbage",), (None,)], "s string")
    got = [r[0] for r in df.select(try_parse_datetime("s")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_safe_divide_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, None, 1.5]


def test_plain_division_by_zero_raises(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    with pytest.raises(Exception):
        df.select(F.col("a") / F.col("b")).collect()


def test_month_arithmetic_clamps_to_month_end(spark):
    df = spark.createDataFrame([(D("2024-05-31"),), (D("2024-02-29"),), (D("1999-05-31"),)], "d date")
    got = df.select(add_months_back("d", 3).alias("m3"), add_months_back("d", 12).alias("y1")).collect()
    assert [tuple(r) for r in got] == [
        (D("2024-02-29"), D("2023-05-31")),
        (D("2023-11-29"), D("2023-02-28")),
        (D("1999-02-28"), D("1998-05-31")),
    ]


def test_money_sum_exact_and_order_free(spark):
    vals = [0.1] * 10 + [0.2] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    assert df.agg(money_sum("x")).first()[0] == 2.0
    assert spark.createDataFrame([], "x double").agg(money_sum("x")).first()[0] is None
