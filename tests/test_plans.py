"""Plan-shape guards: the series operators shuffle once (see README, Design for scale)."""

import io
import re
from contextlib import redirect_stdout

from kabuto.operators.series import cross_rates, gap_filled_series
from tests.conftest import D


def _shuffles(df) -> int:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return len(re.findall(r"Exchange hashpartitioning", buf.getvalue()))


def _exchanges(df) -> list[str]:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return [line for line in buf.getvalue().splitlines() if "Exchange hashpartitioning" in line]


def test_gap_filled_series_shuffles_once(spark):
    vals = spark.createDataFrame(
        [(D("2024-01-01"), "A", "close", 1.0), (D("2024-01-03"), "A", "close", 2.0), (D("2024-01-02"), "B", "open", 3.0)],
        "base_date date, ticker string, ohlc_type string, price double",
    )
    # A table in memory, whose size the planner knows (as it knows that of files).
    flags = spark.sql("SELECT * FROM VALUES ('A', true), ('B', false) AS t(ticker, is_active_weekend)")
    out = gap_filled_series(vals, flags, ["ticker", "ohlc_type"], ["price"], D("2024-01-01"), D("2024-01-10"), 14)
    assert _shuffles(out) == 1  # grid, merge and fill window reuse the series partitioning


def test_cross_rates_shuffle_once(spark):
    filled = spark.createDataFrame(
        [(D("2024-01-05"), "BTC-USD", "close", 2.0, None), (D("2024-01-05"), "JPY=X", "close", 100.0, None)],
        "base_date date, ticker string, ohlc_type string, price double, fetch_time_jst timestamp_ntz",
    )
    out = cross_rates(filled, [("BTC-USD", "JPY=X", "BTC-JPY"), ("ETH-USD", "JPY=X", "ETH-JPY")], 14)
    assert _shuffles(out) == 1  # legs routed once by pair; alignment and window reuse it


def test_open_lots_shuffle_count(spark):
    from kabuto.operators.lots import open_lots

    trades = spark.createDataFrame(
        [(D("2024-01-01"), "X", "buy", "A", 3, 1.0, "m1"), (D("2024-01-02"), "X", "sell", "A", 1, 1.0, "m2")],
        "trade_date date, ticker string, trade_type string, account string, order_count long, price double, memo string",
    )
    # What moves is sums, but for the lots of the cut groups: the day totals, then these by key (for the
    # open groups, the filter and the cut groups alike), the filter's table, the cut groups and
    # their lots (equal ones added up first), the final per-key aggregate.
    lots = open_lots(trades, D("2024-01-31"))
    moved = _exchanges(lots)
    assert sum("_tb0" in x for x in moved) == 1  # the lots themselves: once, below the filter
    assert len(moved) <= 12
