"""Cases where a cap, a prefix or a lenient read would lose data."""

import datetime as dt

import pytest

from kabuto.operators.dedupe import latest_per_key
from kabuto.operators.lots import open_lots, open_lots_units
from kabuto.operators.upsert import upsert_partitions
from kabuto.plans import reports, staging, warehouse
from kabuto.plans.declared import DECLARED
from kabuto.session import scratch_path
from kabuto.sources.raw import read_raw
from kabuto.sources.schemas import RUN_IN_DAYS, RunDates, fill_reach_days
from tests.conftest import D, rows

TRADES = "event_time_jst timestamp_ntz, trade_date date, ticker string, trade_type string, account string, order_count long, price double, memo string"
T = dt.datetime(2024, 1, 2, 9)


def test_tiny_prices_are_not_rounded_away(spark):
    t = spark.createDataFrame([(T, D("2024-01-02"), "X", "buy", "A", 10, 4e-7, "m"), (T, D("2024-01-02"), "Y", "buy", "A", 1, 4e-7, "m"), (T, D("2024-01-03"), "Y", "buy", "A", 2, 1e9, "m")], TRADES)
    fast, literal = (rows(f(t, D("2024-01-05")), "ticker", "position", "avg_buy_price") for f in (open_lots, open_lots_units))
    assert fast == literal and fast[0] == ("X", 10, 4e-7)


def test_first_in_is_first_out_within_a_day(spark):
    later = T.replace(hour=15)
    t = spark.createDataFrame(
        [(T, D("2024-01-02"), "X", "buy", "A", 1, 10.0, "z first"), (later, D("2024-01-02"), "X", "buy", "A", 1, 50.0, "a second"), (later, D("2024-01-02"), "X", "sell", "A", 1, 60.0, "s")],
        TRADES,
    )
    assert rows(warehouse.daily_position(t, D("2024-01-05")), "position", "avg_buy_price") == [(1, 50.0)]


def test_the_run_in_reaches_the_oldest_value_of_a_cross_rate(spark):
    assert fill_reach_days(14) == 20 and RUN_IN_DAYS == 40
    start = D("2024-03-01")
    info = spark.createDataFrame([("BTC-USD", "Crypto", "b", True), ("JPY=X", "為替", "j", False)], "ticker string, asset_type string, asset_name string, is_active_weekend boolean")
    prices = [(start - dt.timedelta(days=k), "BTC-USD", "close", 2.0, T) for k in range(-1, 41)] + [(start - dt.timedelta(days=30), "JPY=X", "close", 100.0, T)]
    staged = spark.createDataFrame(prices, "base_date date, ticker string, ohlc_type string, price double, fetch_time_jst timestamp_ntz")
    got = lambda dates: {r.base_date: r.price for r in warehouse.price_history(staged, info, dates).where("ticker = 'BTC-JPY'").collect()}
    full = got(RunDates(start, start, start - dt.timedelta(days=60)))
    assert full[start] == 200.0 and got(RunDates.backfill(start, start)) == full


def test_a_bad_number_in_a_feed_fails(spark, tmp_path):
    folder = tmp_path / "raw_trade_history"
    folder.mkdir()
    (folder / "f.csv").write_text('timestamp_jst,trade_date,ticker,trade_type,account,order_count,price,memo\n2024/01/02 09:00:00,2024-01-02,X,buy,A,0.5,1.0,m\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_raw(spark, str(tmp_path), "raw_trade_history", "csv").collect()


SCHEMA = "k string, v long, d date"


def test_a_null_partition_keeps_its_rows(spark):
    path = scratch_path(spark, "nulls")
    upsert_partitions(spark, spark.createDataFrame([("a", 1, None), ("b", 2, None), ("c", 3, D("2024-01-01"))], SCHEMA), path, ["k", "d"], "d")
    done = upsert_partitions(spark, spark.createDataFrame([("n", 9, None), ("c", 4, D("2024-01-01"))], SCHEMA), path, ["k", "d"], "d")
    assert done == [None, D("2024-01-01")]
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k", "v") == [("a", 1), ("b", 2), ("c", 4), ("n", 9)]


def test_replacing_with_an_empty_batch_empties_the_partition(spark):
    path, day, other = scratch_path(spark, "empty"), D("2024-01-01"), D("2024-01-02")
    upsert_partitions(spark, spark.createDataFrame([("a", 1, day), ("b", 2, other)], SCHEMA), path, ["k", "d"], "d")
    none = spark.createDataFrame([], SCHEMA)
    assert upsert_partitions(spark, none, path, ["k", "d"], "d") == []
    assert upsert_partitions(spark, none, path, ["k", "d"], "d", replace_partition=True, partitions=[day]) == [day]
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k") == [("b",)]


def test_latest_per_key_is_hashed_and_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 7.0), (1, 3, None), (1, 3, 2.0), (1, 2, 9.0), (2, None, None), (2, None, 4.0), (3, 5, None), (3, None, 8.0)], "k int, t int, p double")
    out = latest_per_key(df, ["k"], ["t", "p"])
    assert rows(out, "k", "t", "p") == [(1, 3, 2.0), (2, None, 4.0), (3, 5, None)]
    plan = warehouse.latest_prices(staging.price_rows(spark.createDataFrame([], "date date, ticker string, ohlc_type string, price double, fetch_time_str string")))
    assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_are_not_reported(spark):
    prices = [(D("2024-01-25"), None, "close", 1.0, T), (D("2024-01-25"), "X", None, 1.0, T), (D("2024-01-25"), "X", "close", 1.0, T)]
    staged = spark.createDataFrame(prices, "base_date date, ticker string, ohlc_type string, price double, fetch_time_jst timestamp_ntz")
    assert rows(reports.price_check_history(staged), "ticker", "ohlc_type") == [("X", "close")]


def test_declared_checks_are_complete():
    kinds = [c.kind for checks in DECLARED.values() for c in checks]
    assert kinds.count("not_null") == 88 and kinds.count("expression_is_true") == 8
    assert kinds.count("unique") == 2 and kinds.count("accepted_values") == 1


def test_reports_come_in_order(spark):
    prices = [(D(d), t, "close", 1.0, T) for d in ("2024-01-23", "2024-01-25", "2024-01-22") for t in ("B", "A")]
    staged = spark.createDataFrame(prices, "base_date date, ticker string, ohlc_type string, price double, fetch_time_jst timestamp_ntz").repartition(4)
    got = [(r.ticker, r.base_date) for r in reports.weekday_price_report(staged, D("2024-01-01"), D("2024-01-31")).collect()]
    assert got == sorted(got, key=lambda x: (x[0], -x[1].toordinal()))
    got = [(r.ticker, r.base_date) for r in reports.price_check_report(staged, D("2024-01-01"), D("2024-01-31")).collect()]
    assert got == sorted(got)
