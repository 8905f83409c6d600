"""Explicit schemas of the raw feeds, the CSV dimensions and the published tables, plus run dates.

Nothing is inferred: every reader passes one of these StructTypes.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STR, BOOL, LONG, DBL, DATE, TS = (
    T.StringType(),
    T.BooleanType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
)

# Raw feeds (as landed; datetimes still text).
RAW_ASSET_STATUS_HISTORY = _s(("event_time_jst_str", STR), ("ticker", STR), ("is_monitor", BOOL), ("is_watch", BOOL))
RAW_ASSET_NAME_MASTER = _s(("ticker", STR), ("asset_type", STR), ("asset_name", STR))  # declared, no consumer
RAW_TRADE_HISTORY = _s(
    ("timestamp_jst", STR),
    ("trade_date", DATE),
    ("ticker", STR),
    ("trade_type", STR),
    ("account", STR),
    ("order_count", LONG),
    ("price", DBL),
    ("memo", STR),
)
RAW_PRICE_DATA = _s(("date", DATE), ("ticker", STR), ("ohlc_type", STR), ("price", DBL), ("fetch_time_str", STR))
RAW_ENTRY_POINT = _s(("add_date", DATE), ("ticker", STR), ("entry_price", DBL), ("memo", STR))

# CSV dimensions.
REF_TICKER_INFO = _s(("ticker", STR), ("asset_type", STR), ("asset_name", STR), ("is_active_weekend", BOOL))
DIM_SUMMARY_TICKER_LIST = _s(("ticker", STR), ("order_group", LONG), ("order_index", LONG))
DIM_MAX_PRICE = _s(("ticker", STR), ("order_group", LONG), ("order_index", LONG))

RAW_TABLES = {
    "raw_asset_status_history": RAW_ASSET_STATUS_HISTORY,
    "raw_asset_name_master": RAW_ASSET_NAME_MASTER,
    "raw_trade_history": RAW_TRADE_HISTORY,
    "raw_price_data": RAW_PRICE_DATA,
    "raw_entry_point": RAW_ENTRY_POINT,
}
SEED_TABLES = {
    "ref_ticker_info": REF_TICKER_INFO,
    "dim_summary_ticker_list": DIM_SUMMARY_TICKER_LIST,
    "dim_max_price": DIM_MAX_PRICE,
}

# Column contracts of the published tables (names in emitted order).
PRICE_HISTORY_COLUMNS = ["base_date", "ticker", "ohlc_type", "price", "fetch_time_jst"]

# Fixed values the models depend on.
# Allowed asset types of the ticker dimension.
ASSET_TYPES = ["指数", "株", "為替", "金利", "Crypto", "コモディティ", "REIT"]
# Derived cross rates: (base leg, quote leg, published ticker), close prices only.
CROSS_RATE_PAIRS = [("BTC-USD", "JPY=X", "BTC-JPY"), ("ETH-USD", "JPY=X", "ETH-JPY")]
CLOSE = "close"
FILL_MAX_ROWS = 14


def fill_reach_days(max_rows: int = FILL_MAX_ROWS) -> int:
    """How many days back a fill over ``max_rows`` earlier rows can reach: on a weekday calendar five
    rows take seven days, and the stretch may begin and end at a weekend."""
    return max_rows + 2 * (max_rows // 5 + 1)


# A cross rate fills its quote on the weekday calendar and then again over the base's rows, so a
# value can travel two fills; this much history before the first written date makes it complete.
RUN_IN_DAYS = 2 * fill_reach_days()


@dataclass(frozen=True)
class RunDates:
    """Frozen run parameters. ``as_of`` is the valuation date (the day before the run).

    update_from:  first date written by incremental tables (default as_of - 2)
    history_from: first date read for look-back windows (default as_of - 27, and as long before an
                  update_from that is given: update_from - 25)

    Dates out of order (history_from <= update_from <= as_of) are refused: rows before
    history_from could not be written.
    """

    as_of: _dt.date
    update_from: _dt.date | None = None
    history_from: _dt.date | None = None

    def __post_init__(self):
        as_of = _to_date(self.as_of)
        object.__setattr__(self, "as_of", as_of)
        uf = _to_date(self.update_from) if self.update_from else as_of - _dt.timedelta(days=2)
        hf = _to_date(self.history_from) if self.history_from else uf - _dt.timedelta(days=25)
        object.__setattr__(self, "update_from", uf)
        object.__setattr__(self, "history_from", hf)
        if not hf <= uf <= as_of:
            raise ValueError(f"run dates out of order: {self}")

    @classmethod
    def for_run_day(cls, run_day: _dt.date) -> "RunDates":
        """Dates of a scheduled run on ``run_day`` (valuation the day before)."""
        d = _to_date(run_day)
        return cls(d - _dt.timedelta(days=1), d - _dt.timedelta(days=3), d - _dt.timedelta(days=28))

    @classmethod
    def backfill(cls, start: _dt.date, end: _dt.date, history_from: _dt.date | None = None) -> "RunDates":
        """Recompute and write every date in [start, end] in one run, reading a run-in before
        ``start`` (default: as far as a filled value can come from)."""
        start = _to_date(start)
        return cls(end, start, history_from or start - _dt.timedelta(days=RUN_IN_DAYS))


def _to_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))
