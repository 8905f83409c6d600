import datetime as dt

from kabuto.plans import reports
from tests.conftest import D, rows

PRICES = "base_date date, ticker string, ohlc_type string, price double, fetch_time_jst timestamp_ntz"
T1, T2 = dt.datetime(2024, 1, 26, 9), dt.datetime(2024, 1, 27, 9)


def test_weekend_falls_back_to_friday_per_column(spark):
    stg = spark.createDataFrame(
        [
            (D("2024-01-26"), "W", "close", 10.0, T1),  # Friday
            (D("2024-01-27"), "W", "close", None, T2),  # Saturday: own fetch time, Friday's price
            (D("2024-01-24"), "W", "close", None, T1),  # Wednesday with no price: no row
        ],
        PRICES,
    )
    got = rows(reports.price_check_history(stg), "base_date", "price", "fetch_time_jst")
    assert got == [(D("2024-01-26"), 10.0, T1), (D("2024-01-27"), 10.0, T2), (D("2024-01-28"), 10.0, T1)]


def test_trailing_filter_binds_to_last_arm_only(spark):
    data = []
    for day in [D("2024-01-10"), D("2024-01-25")]:  # both Wednesdays/Thursdays
        data += [(day, "BTC-USD", "close", 2.5, T1), (day, "ETH-USD", "close", 1.5, T1), (day, "JPY=X", "close", 3.0, T1)]
    stg = spark.createDataFrame(data, PRICES)
    out = reports.price_check_report(stg, D("2024-01-21"), D("2024-01-28"))
    got = rows(out.filter("ticker like '%-JPY'"), "ticker", "base_date", "price")
    # BTC-JPY keeps every date (2.5 x 3.0 = 7.5 rounds half away from zero to 8); ETH-JPY only inside the window
    assert got == [("BTC-JPY", D("2024-01-10"), 8.0), ("BTC-JPY", D("2024-01-25"), 8.0), ("ETH-JPY", D("2024-01-25"), 5.0)]
    everywhere = reports.price_check_report(stg, D("2024-01-21"), D("2024-01-28"), filter_all_arms=True)
    assert {r["base_date"] for r in everywhere.collect()} == {D("2024-01-25")}


def test_weekday_report_adjusted_dates(spark):
    ph = spark.createDataFrame([(D("2024-01-28"), "D", "close", 1.0, T1), (D("2024-01-28"), "D", "open", 1.0, T1)], PRICES)
    got = rows(reports.weekday_price_report(ph, D("2024-01-21"), D("2024-01-28")), "base_date", "adjusted_date", "ohlc_type")
    assert got == [(D("2024-01-28"), D("2024-01-26"), "close")]
