import datetime as dt

from kabuto.operators.series import calendar_grid, cross_rates, gap_filled_series
from kabuto.plans import warehouse
from kabuto.sources.schemas import RunDates
from tests.conftest import D, rows

FLAGS = "ticker string, asset_type string, asset_name string, is_active_weekend boolean"
PRICES = "base_date date, ticker string, ohlc_type string, price double, fetch_time_jst timestamp_ntz"


def _flags(spark, pairs):
    return spark.createDataFrame([(t, "x", t, f) for t, f in pairs], FLAGS)


def test_calendar_flag_semantics(spark):
    keys = spark.createDataFrame([("D", True), ("W", False), ("N", None)], "ticker string, is_active_weekend boolean")
    g = calendar_grid(keys, D("2024-01-26"), D("2024-01-29"))  # Fri .. Mon
    got = rows(g, "ticker", "base_date")
    assert got == [
        ("D", D("2024-01-26")),
        ("D", D("2024-01-27")),
        ("D", D("2024-01-28")),
        ("D", D("2024-01-29")),
        ("W", D("2024-01-26")),
        ("W", D("2024-01-29")),
    ]


def _series(spark, ticker, flag, start, values):
    """values: {day offset: price or None} -> dense filled series as {date: price}."""
    vals = spark.createDataFrame(
        [(start + dt.timedelta(days=k), ticker, "close", v) for k, v in values.items()], "base_date date, ticker string, ohlc_type string, price double"
    )
    end = start + dt.timedelta(days=max(values) + 30)
    out = gap_filled_series(vals, _flags(spark, [(ticker, flag)]), ["ticker", "ohlc_type"], ["price"], start, end, 14)
    return {r["base_date"]: r["price"] for r in out.collect()}


def test_fill_reaches_14_rows_not_15(spark):
    start = D("2024-01-01")
    got = _series(spark, "D", True, start, {0: 10.0})
    assert got[start + dt.timedelta(days=14)] == 10.0
    assert got[start + dt.timedelta(days=15)] is None


def test_fill_counts_weekday_rows_for_weekday_tickers(spark):
    start = D("2024-01-01")  # Monday
    got = _series(spark, "W", False, start, {0: 5.0})
    weekdays = sorted(got)
    assert all(d.weekday() < 5 for d in weekdays)
    assert got[weekdays[14]] == 5.0 and got[weekdays[15]] is None  # 14 rows = 20 calendar days


def test_null_price_takes_older_value_and_weekend_value_dropped(spark):
    start = D("2024-01-01")
    got = _series(spark, "W", False, start, {0: 1.0, 1: None, 5: 7.0, 6: 8.0})  # day 5/6 = Sat/Sun
    assert got[start + dt.timedelta(days=1)] == 1.0  # NULL price falls back to the day before
    assert start + dt.timedelta(days=5) not in got  # weekend rows of a weekday ticker vanish
    assert got[start + dt.timedelta(days=7)] == 1.0  # ... so the next Monday still carries day 0


def test_unknown_or_null_flag_ticker_has_no_rows(spark):
    start = D("2024-01-01")
    assert _series(spark, "N", None, start, {0: 1.0}) == {}


def test_price_and_fetch_time_fill_independently(spark):
    t0 = dt.datetime(2024, 1, 1, 9, 0, 0)
    t1 = dt.datetime(2024, 1, 2, 9, 0, 0)
    vals = spark.createDataFrame(
        [(D("2024-01-01"), "D", "close", 10.0, t0), (D("2024-01-02"), "D", "close", None, t1)], PRICES
    )
    out = gap_filled_series(vals, _flags(spark, [("D", True)]), ["ticker", "ohlc_type"], ["price", "fetch_time_jst"], D("2024-01-01"), D("2024-01-03"), 14)
    got = rows(out, "base_date", "price", "fetch_time_jst")
    assert got == [(D("2024-01-01"), 10.0, t0), (D("2024-01-02"), 10.0, t1), (D("2024-01-03"), 10.0, t1)]


def _filled(spark, data):
    return spark.createDataFrame(data, PRICES)


def test_cross_rate_uses_last_quote_and_null_without_quote(spark):
    t = dt.datetime(2024, 1, 1)
    data = [
        (D("2024-01-05"), "BTC-USD", "close", 2.0, t),  # Friday
        (D("2024-01-06"), "BTC-USD", "close", 3.0, t),  # Saturday: quote missing -> last quote
        (D("2024-01-05"), "JPY=X", "close", 100.0, t),
        (D("2024-01-05"), "ETH-USD", "close", 5.0, t),  # ETH leg, but only the BTC pair here
    ]
    out = cross_rates(_filled(spark, data), [("BTC-USD", "JPY=X", "BTC-JPY"), ("ETH-USD", "EUR=X", "ETH-EUR")], 14)
    got = rows(out, "ticker", "base_date", "price")
    assert got == [
        ("BTC-JPY", D("2024-01-05"), 200.0),
        ("BTC-JPY", D("2024-01-06"), 300.0),
        ("ETH-EUR", D("2024-01-05"), None),  # quote leg missing entirely: row kept, price NULL
    ]


def test_price_history_trims_after_filling(spark):
    t = dt.datetime(2024, 1, 1)
    stg = _filled(
        spark,
        [
            (D("2024-01-01"), "D", "close", 1.0, t),
            (D("2024-01-01"), "D", "close", 2.0, dt.datetime(2024, 1, 1, 12)),  # later fetch wins
        ],
    )
    out = warehouse.price_history(stg, _flags(spark, [("D", True)]), RunDates(D("2024-01-10"), D("2024-01-09"), D("2024-01-01")))
    got = rows(out, "base_date", "price")
    assert got == [(D("2024-01-09"), 2.0), (D("2024-01-10"), 2.0)]


def test_null_series_key_keeps_calendar_without_values(spark):
    vals = spark.createDataFrame(
        [(D("2024-01-01"), "D", None, 3.0), (D("2024-01-01"), "D", "close", 4.0)], "base_date date, ticker string, ohlc_type string, price double"
    )
    out = gap_filled_series(vals, _flags(spark, [("D", True)]), ["ticker", "ohlc_type"], ["price"], D("2024-01-01"), D("2024-01-02"), 14)
    assert rows(out, "ohlc_type", "base_date", "price") == [
        (None, D("2024-01-01"), None),
        (None, D("2024-01-02"), None),
        ("close", D("2024-01-01"), 4.0),
        ("close", D("2024-01-02"), 4.0),
    ]
