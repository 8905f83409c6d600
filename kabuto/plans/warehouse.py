"""Warehouse layer: reusable tables built from staging (latest status, cash ledger, dense price
history, close prices, FIFO positions)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.operators.dedupe import latest_per_key
from kabuto.operators.dims import enrich
from kabuto.operators.ledger import mirror_cash
from kabuto.operators.lots import open_lots, open_lots_units
from kabuto.operators.series import cross_rates, gap_filled_series
from kabuto.sources.schemas import CLOSE, CROSS_RATE_PAIRS, FILL_MAX_ROWS, PRICE_HISTORY_COLUMNS, RunDates

# Total orders replacing the arbitrary tie order of the warehouse's ROW_NUMBER calls.
STATUS_ORDER = ["event_time_jst", "is_monitor", "is_watch"]  # all descending, NULLs last
FETCH_ORDER = ["fetch_time_jst", "price"]

# First in is first out: within a day by the time of the trade, then by what else tells lots apart.
TRADE_TIE_BREAK = ("event_time_jst", "memo", "price", "order_count")

PRICE_KEYS = ["ticker", "base_date", "ohlc_type"]
POSITION_KEYS = ["account", "ticker", "partition_date"]


def asset_master(stg_status: DataFrame, ticker_info: DataFrame) -> DataFrame:
    """Latest monitoring status per ticker with its name and type (NULL if not in the dimension)."""
    latest = latest_per_key(stg_status, ["ticker"], STATUS_ORDER)
    return enrich(latest, ticker_info, "ticker", ["asset_name", "asset_type"]).select(
        "ticker",
        "asset_name",
        "asset_type",
        "is_monitor",
        "is_watch",
        F.col("event_time_jst").alias("latest_status_chg_time_jst"),
    )


def trade_history_with_cash(stg_trades: DataFrame) -> DataFrame:
    return mirror_cash(stg_trades)


def latest_prices(stg_prices: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Newest fetch per (base_date, ticker, ohlc_type), optionally within [start, end]; among
    equal fetch times the higher price wins (NULL last). Exact repeats in the feed do not
    change the pick, so un-deduplicated staging rows may be passed."""
    rows = stg_prices
    if start is not None:
        rows = rows.filter(F.col("base_date").between(F.lit(start), F.lit(end)))
    return latest_per_key(rows, ["base_date", "ticker", "ohlc_type"], FETCH_ORDER)


def filled_prices(stg_prices: DataFrame, ticker_info: DataFrame, dates: RunDates, max_rows: int = FILL_MAX_ROWS) -> DataFrame:
    """Every (ticker, ohlc_type) seen in the look-back on its own calendar over the look-back,
    price and fetch time each forward-filled over at most ``max_rows`` rows."""
    latest = latest_prices(stg_prices, dates.history_from, dates.as_of)
    return gap_filled_series(
        latest,
        ticker_info,
        ["ticker", "ohlc_type"],
        ["price", "fetch_time_jst"],
        dates.history_from,
        dates.as_of,
        max_rows,
    )


def price_history(
    stg_prices: DataFrame,
    ticker_info: DataFrame,
    dates: RunDates,
    pairs: Sequence[tuple[str, str, str]] = CROSS_RATE_PAIRS,
    max_rows: int = FILL_MAX_ROWS,
) -> DataFrame:
    """Dense, gap-filled price history plus derived cross rates, rows in [update_from, as_of].

    The look-back [history_from, as_of] is read so the fill frame is complete; the trim to the
    update range is applied after the windows (it cannot and must not move below them).
    """
    filled = filled_prices(stg_prices, ticker_info, dates, max_rows)
    derived = cross_rates(filled, pairs, max_rows)
    out = filled.select(*PRICE_HISTORY_COLUMNS).unionByName(derived.select(*PRICE_HISTORY_COLUMNS))
    return out.filter(F.col("base_date").between(F.lit(dates.update_from), F.lit(dates.as_of)))


def close_price_history(prices: DataFrame) -> DataFrame:
    return prices.filter(F.col("ohlc_type") == CLOSE).select(*PRICE_HISTORY_COLUMNS)


def daily_position(stg_trades: DataFrame, as_of: dt.date, split: str = "day") -> DataFrame:
    """Open FIFO position and average buy price per (account, ticker) at ``as_of``."""
    return open_lots(stg_trades, as_of, tie_break=TRADE_TIE_BREAK, split=split)


def daily_position_units(stg_trades: DataFrame, as_of: dt.date) -> DataFrame:
    """Same result through unit expansion (verification form)."""
    return open_lots_units(stg_trades, as_of, tie_break=TRADE_TIE_BREAK)
