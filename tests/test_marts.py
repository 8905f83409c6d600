import datetime as dt

import pytest

from kabuto.plans import marts
from tests.conftest import D, rows

FLAGS = "ticker string, asset_type string, asset_name string, is_active_weekend boolean"
POS = "account string, ticker string, position long, avg_buy_price double, partition_date date"
CLOSE = "base_date date, ticker string, ohlc_type string, price double, fetch_time_jst timestamp_ntz"
TRADES = "event_time_jst timestamp_ntz, trade_date date, ticker string, trade_type string, account string, order_count long, price double, memo string"
SUNDAY = D("2024-01-28")
T = dt.datetime(2024, 1, 1)


def _dim(spark):
    return spark.createDataFrame([("D", "Crypto", "d", True), ("W", "株", "w", False), ("N", "株", "n", None)], FLAGS)


def _close(spark):
    return spark.createDataFrame(
        [
            (D("2024-01-26"), "W", "close", 110.0, T),  # Friday close for weekday tickers
            (D("2024-01-26"), "N", "close", 50.0, T),
            (SUNDAY, "D", "close", 20.0, T),
            (D("2024-01-26"), "D", "close", 18.0, T),
        ],
        CLOSE,
    )


def test_position_value_rolls_back_weekend_and_null_flag(spark):
    pos = spark.createDataFrame(
        [("A", "W", 2, 100.0, SUNDAY), ("A", "D", 1, 10.0, SUNDAY), ("A", "N", 1, 25.0, SUNDAY), ("A", "Q", 1, 1.0, SUNDAY)], POS
    )
    out = marts.position_value(pos, _dim(spark), _close(spark), SUNDAY)
    got = rows(out, "ticker", "close_price", "unrealized_value", "unrealized_return_ratio")
    assert got == [("D", 20.0, 10.0, 1.0), ("N", 50.0, 25.0, 1.0), ("Q", None, None, None), ("W", 110.0, 20.0, 0.1)]


def test_position_value_zero_average_raises(spark):
    pos = spark.createDataFrame([("A", "W", 2, 0.0, SUNDAY)], POS)
    with pytest.raises(Exception):
        marts.position_value(pos, _dim(spark), _close(spark), SUNDAY).collect()


def test_all_term_pl_sell_only_and_closed_keys(spark):
    trades = spark.createDataFrame(
        [
            (T, D("2024-01-02"), "W", "sell", "A", 1, 10.0, "1"),  # sell-only key: total_buy NULL
            (T, D("2024-01-02"), "D", "buy", "A", 2, 10.0, "2"),
            (T, D("2024-01-03"), "D", "sell", "A", 2, 15.0, "3"),  # closed out: no position row
        ],
        TRADES,
    )
    pos = spark.createDataFrame([], POS)
    got = rows(
        marts.all_term_pl(trades, pos, _dim(spark), _close(spark), SUNDAY),
        "ticker", "asset_type", "total_buy_amount", "total_sell_amount", "pl_amount_all_term", "pl_ratio_all_term",
    )
    assert got == [("D", None, 20.0, 30.0, 10.0, 0.5), ("W", None, None, 10.0, None, None)]


def test_aum_cash_and_positions(spark):
    trades = spark.createDataFrame(
        [
            (T, D("2024-01-02"), "cash", "buy", "A", 1, 1000.0, "1"),
            (T, D("2024-01-02"), "cash", "sell", "A", 1, 300.0, "2"),
            (T, D("2024-01-02"), "cash", None, "A", 1, 1.0, "3"),  # anything but buy subtracts
            (T, D("2024-01-03"), "W", "buy", "A", 2, 50.0, "4"),  # cash leg: sell 100
            (T, D("2024-01-04"), "W", "sell", "A", 1, 80.0, "5"),  # cash leg: buy 80
            (T, D("2024-01-04"), "W", None, "A", 1, 5.0, "6"),  # NULL side mirrors to a buy
            (T, D("2024-01-04"), None, "buy", "A", 1, 7.0, "7"),  # NULL ticker: no cash leg
            (T, D("2024-02-04"), "cash", "buy", "A", 1, 9.0, "8"),  # after the as-of date
        ],
        TRADES,
    )
    pos = spark.createDataFrame([("A", "W", 3, 100.0, SUNDAY)], POS)
    got = rows(marts.aum(trades, pos, _dim(spark), _close(spark), SUNDAY), "ticker", "position", "value_price", "current_value")
    assert got == [("W", 3.0, 110.0, 330.0), ("cash", 684.0, 1.0, 684.0)]
    # Same balance as the mirrored cash ledger summed the way the original does.
    from kabuto.operators.ledger import mirror_cash, signed_balance

    ledger = signed_balance(mirror_cash(trades), SUNDAY, only="cash", out="b").select("b").first()[0]
    assert ledger == 684.0


def test_summary_dates_null_flag_and_weekend_prev(spark):
    lst = spark.createDataFrame([("D", 1, 1), ("W", 1, 2), ("N", 1, 3)], "ticker string, order_group long, order_index long")
    out = marts.daily_summary(lst, _dim(spark), _close(spark), SUNDAY)
    got = {r["ticker"]: (r["recent_date"], r["prev_date"], r["date_7day_ago"], r["date_28day_ago"]) for r in out.collect()}
    assert got["D"] == (SUNDAY, D("2024-01-27"), D("2024-01-21"), D("2023-12-31"))
    # weekday-only on a Sunday: recent = Friday, prev = Friday - 1 = Thursday
    assert got["W"] == (D("2024-01-26"), D("2024-01-25"), D("2024-01-19"), D("2023-12-29"))
    assert got["N"] == (None, None, None, None)  # CASE without ELSE
    d = [r for r in out.collect() if r["ticker"] == "D"][0]
    assert d["price_recent_date"] == 20.0 and d["price_prev_date"] is None and d["rate_recent_prev"] is None


def test_period_high_ties_and_all_null_period(spark):
    close = spark.createDataFrame(
        [
            (D("1999-05-10"), "X", "close", 5.0, T),
            (D("1999-04-10"), "X", "close", 5.0, T),  # tie: earliest date wins
            (D("1998-07-01"), "X", "close", 9.0, T),  # only inside the 1-year period
            (D("1999-05-20"), "Y", "close", None, T),  # all-NULL period: earliest date, NULL max
            (D("1999-05-01"), "Y", "close", None, T),
        ],
        CLOSE,
    )
    lst = spark.createDataFrame([("X", 1, 1), ("Y", 1, 2), ("Z", 1, 3)], "ticker string, order_group long, order_index long")
    out = {r["ticker"]: r for r in marts.period_high(lst, _dim(spark), close, D("1999-05-31")).collect()}
    assert (out["X"]["max_price_3month"], out["X"]["max_price_date_3month"]) == (5.0, D("1999-04-10"))
    assert (out["X"]["max_price_1year"], out["X"]["max_price_date_1year"]) == (9.0, D("1998-07-01"))
    assert (out["Y"]["max_price_3month"], out["Y"]["max_price_date_3month"]) == (None, D("1999-05-01"))
    assert out["Z"]["max_price_3month"] is None and out["Z"]["max_price_date_3month"] is None


def test_entry_watch_one_row_per_entry(spark):
    entries = spark.createDataFrame(
        [(D("2024-01-02"), "W", 120.0, "a"), (D("2024-01-03"), "W", 100.0, "b"), (D("2024-01-03"), "Q", 1.0, "c")],
        "add_date date, ticker string, entry_price double, memo string",
    )
    got = rows(marts.entry_watch(entries, _dim(spark), _close(spark), SUNDAY), "memo", "is_reached_entry_price", "recent_price")
    assert got == [("a", True, 110.0), ("b", False, 110.0), ("c", None, None)]


def test_flow_table_gives_the_direct_totals(spark):
    from kabuto.operators import ledger as L

    trades = spark.createDataFrame(
        [
            (T, D("2024-01-02"), "W", "buy", "A", 2, 10.25, "1"),
            (T, D("2024-01-02"), "W", "sell", "A", None, 3.0, "2"),  # NULL quantity
            (T, D("2024-01-03"), "W", None, "A", 1, 4.0, "3"),  # NULL side subtracts from net
            (T, D("2024-01-03"), "cash", "buy", "A", 1, 100.0, "4"),
            (T, D("2024-01-03"), None, "buy", "B", 1, 1.0, "5"),  # NULL ticker
            (T, D("2024-01-04"), "X", "sell", "B", 3, 2.5, "6"),  # sell-only key
        ],
        TRADES,
    )
    flows = L.trade_flows(trades, SUNDAY)
    assert rows(L.totals_from_flows(flows)) == rows(L.trade_totals(trades, SUNDAY))
    assert rows(L.net_from_flows(flows)) == rows(L.net_units(trades, SUNDAY))
    assert rows(L.cash_from_flows(flows)) == rows(L.cash_balance(trades, SUNDAY))
