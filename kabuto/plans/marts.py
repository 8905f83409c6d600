"""Marts: one table per use, all valued at the run's as-of date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kabuto.functions.columns import add_months_back, as_date, is_weekend, prev_weekday, safe_divide, valuation_date
from kabuto.operators.dims import bounded_broadcast, enrich
from kabuto.operators.ledger import cash_balance, trade_totals
from kabuto.operators.period import period_highs
from kabuto.operators.range_max import range_highs
from kabuto.operators.series import close_on_valuation_date

# Look-back of the close prices each mart reads (days before as-of).
VALUATION_LOOKBACK = 6
SUMMARY_LOOKBACK = 30
ENTRY_LOOKBACK = 7
HIGH_PERIODS = {"3month": 3, "6month": 6, "1year": 12}

DBL = T.DoubleType()


def _positions_at(positions: DataFrame, as_of: dt.date) -> DataFrame:
    return positions.filter(F.col("partition_date") == as_date(as_of))


def _valued_positions(positions: DataFrame, ticker_info: DataFrame, close: DataFrame, as_of: dt.date) -> DataFrame:
    """Positions at ``as_of`` with asset attributes and the close on each ticker's valuation date."""
    pos = enrich(_positions_at(positions, as_of), ticker_info, "ticker", ["asset_type", "asset_name"])
    px = close_on_valuation_date(close, ticker_info, as_of, VALUATION_LOOKBACK)
    # One row per ticker, computed from the price pipeline: AQE broadcasts it from its real size.
    return pos.join(px, "ticker", "left")


def position_value(positions: DataFrame, ticker_info: DataFrame, close: DataFrame, as_of: dt.date) -> DataFrame:
    """Unrealized value and return per open position. The ratio divides by the average buy
    price with plain division (a zero average raises)."""
    v = _valued_positions(positions, ticker_info, close, as_of)
    gain = F.col("close_price") - F.col("avg_buy_price")
    return v.select(
        "account",
        "ticker",
        "asset_type",
        "asset_name",
        "position",
        "avg_buy_price",
        "close_price",
        (gain * F.col("position")).alias("unrealized_value"),
        (gain / F.col("avg_buy_price")).alias("unrealized_return_ratio"),
        as_date(as_of).alias("partition_date"),
    )


AUM_COLUMNS = ["account", "ticker", "asset_type", "asset_name", "position", "value_price", "current_value", "partition_date"]


def aum(
    trades: DataFrame, positions: DataFrame, ticker_info: DataFrame, close: DataFrame, as_of: dt.date, cash: DataFrame | None = None
) -> DataFrame:
    """Assets under management: cash balance rows plus each open position at its close.

    ``trades`` are the staged trades; the cash balance is that of the mirrored cash ledger
    (``trade_history_with_cash``), computed in one pass without building the ledger, or given
    as ``cash`` (account, ticker, current_value), e.g. from ``ledger.cash_from_flows``.
    """
    d = as_date(as_of)
    if cash is None:
        cash = cash_balance(trades, as_of, out="current_value")
    cash = cash.select(
        "account",
        "ticker",
        F.lit("cash").alias("asset_type"),
        F.lit("cash").alias("asset_name"),
        F.col("current_value").alias("position"),
        F.lit(1.0).alias("value_price"),
        "current_value",
        d.alias("partition_date"),
    )
    held = _valued_positions(positions, ticker_info, close, as_of).select(
        "account",
        "ticker",
        "asset_type",
        "asset_name",
        F.col("position").cast(DBL).alias("position"),
        F.col("close_price").alias("value_price"),
        (F.col("close_price") * F.col("position")).alias("current_value"),
        d.alias("partition_date"),
    )
    return cash.unionByName(held)


def all_term_pl(
    trades: DataFrame, positions: DataFrame, ticker_info: DataFrame, close: DataFrame, as_of: dt.date, totals: DataFrame | None = None
) -> DataFrame:
    """All-term profit and loss per (account, ticker): realised sells plus the open position
    valued at its close, against everything bought. Attributes come from the open position, so
    closed-out keys carry NULL asset_type/asset_name."""
    if totals is None:
        totals = trade_totals(trades, as_of)
    valued = _valued_positions(positions, ticker_info, close, as_of).select(
        "account", "ticker", "asset_type", "asset_name", (F.col("position") * F.col("close_price")).alias("_close_amount")
    )
    j = totals.join(valued, ["account", "ticker"], "left")
    sold = F.coalesce("sell_amount_already", F.lit(0.0))
    closing = F.coalesce("_close_amount", F.lit(0.0))
    total_sell = sold + closing
    return j.select(
        "account",
        "ticker",
        "asset_type",
        "asset_name",
        "total_buy_amount",
        sold.alias("sell_amount_already"),
        closing.alias("position_close_amount"),
        total_sell.alias("total_sell_amount"),
        (total_sell - F.col("total_buy_amount")).alias("pl_amount_all_term"),
        (safe_divide(total_sell, F.col("total_buy_amount")) - F.lit(1)).alias("pl_ratio_all_term"),
        as_date(as_of).alias("partition_date"),
    )


def summary_dates(base_date, weekend_flag: str = "is_active_weekend") -> dict[str, F.Column]:
    """Comparison dates for the daily summary. Weekend-trading tickers use calendar days;
    weekday-only tickers roll back to weekdays; a NULL flag gives NULL dates."""
    d = as_date(base_date)
    on = F.col(weekend_flag)
    off = ~F.col(weekend_flag)

    def by_flag(daily, weekday):
        return F.when(on, daily).when(off, weekday)

    return {
        "recent_date": by_flag(d, prev_weekday(d)),
        "prev_date": F.when(on, F.date_sub(d, 1))
        .when(off & is_weekend(d), F.date_sub(prev_weekday(d), 1))
        .when(off & ~is_weekend(d), prev_weekday(F.date_sub(d, 1))),
        "date_7day_ago": by_flag(F.date_sub(d, 7), prev_weekday(F.date_sub(d, 7))),
        "date_28day_ago": by_flag(F.date_sub(d, 28), prev_weekday(F.date_sub(d, 28))),
    }


SUMMARY_ROLES = [
    ("recent_date", "price_recent_date"),
    ("prev_date", "price_prev_date"),
    ("date_7day_ago", "price_7day_ago"),
    ("date_28day_ago", "price_28day_ago"),
]


def daily_summary(ticker_list: DataFrame, ticker_info: DataFrame, prices: DataFrame, as_of: dt.date) -> DataFrame:
    """Per listed ticker: close on the recent, previous, 7-day-ago and 28-day-ago dates, their
    differences and change rates (NULL when the older price is zero or missing).

    The four lookups are one pass: each close row is tagged with its ticker's four dates and the
    prices are picked by a conditional aggregate per ticker, then joined to the list once.
    """
    d = as_date(as_of)
    dates = summary_dates(d)
    listed = enrich(ticker_list, ticker_info, "ticker", ["asset_name", "is_active_weekend"]).withColumn("base_date", d)
    listed = listed.select("*", *[e.alias(n) for n, e in dates.items()])

    close = prices.filter(F.col("base_date").between(F.date_sub(d, SUMMARY_LOOKBACK), d) & (F.col("ohlc_type") == "close"))
    flags = bounded_broadcast(ticker_info).select("ticker", "is_active_weekend")
    tagged = close.join(flags, "ticker", "left").select(
        "ticker", "base_date", "price", *[e.alias(n) for n, e in dates.items()]
    )
    picked = tagged.groupBy("ticker").agg(
        *[F.max(F.when(F.col("base_date") == F.col(role), F.col("price"))).alias(out) for role, out in SUMMARY_ROLES]
    )
    j = listed.join(picked, "ticker", "left")
    p1 = F.col("price_recent_date")
    diffs, rates = [], []
    for out, suffix in [("price_prev_date", "prev"), ("price_7day_ago", "7day"), ("price_28day_ago", "28day")]:
        diffs.append((p1 - F.col(out)).alias(f"diff_recent_{suffix}"))
        rates.append(safe_divide(p1 - F.col(out), F.col(out)).alias(f"rate_recent_{suffix}"))
    return j.select(
        "ticker",
        "order_group",
        "order_index",
        "asset_name",
        "is_active_weekend",
        "base_date",
        *dates.keys(),
        *[out for _, out in SUMMARY_ROLES],
        *diffs,
        *rates,
    )


def period_high(price_list: DataFrame, ticker_info: DataFrame, close: DataFrame, as_of: dt.date) -> DataFrame:
    """Per listed ticker: recent close and the highest close (with its date) over 3 months,
    6 months and 1 year ending at ``as_of``."""
    d = as_date(as_of)
    listed = enrich(price_list, ticker_info, "ticker", ["asset_name", "is_active_weekend"]).withColumn(
        "recent_price_date", valuation_date(d, "is_active_weekend")
    )
    flags = bounded_broadcast(ticker_info).select("ticker", "is_active_weekend")
    year = close.select("ticker", "base_date", "price").join(flags, "ticker", "left")
    recent = F.max(F.when(F.col("base_date") == valuation_date(d, "is_active_weekend"), F.col("price")))
    highs = period_highs(year, as_of, HIGH_PERIODS, extra={"recent_price": recent})
    j = listed.join(highs, "ticker", "left")
    cols = []
    for label in HIGH_PERIODS:
        cols += [F.col(f"max_price_{label}"), F.col(f"max_price_date_{label}")]
    return j.select("order_group", "order_index", "ticker", "asset_name", "recent_price_date", "recent_price", *cols, d.alias("base_date"))


def period_high_from_blocks(price_list: DataFrame, ticker_info: DataFrame, close: DataFrame, blocks: DataFrame, as_of: dt.date) -> DataFrame:
    """``period_high`` from ``range_max.block_maxima`` of all closes: the closes themselves are read in the
    months that the periods cut, and on the recent dates."""
    d = as_date(as_of)
    listed = enrich(price_list, ticker_info, "ticker", ["asset_name", "is_active_weekend"]).withColumn("recent_price_date", valuation_date(d, "is_active_weekend"))
    label = F.explode(F.array(*[F.struct(F.lit(n).alias("label"), add_months_back(d, m).alias("start")) for n, m in HIGH_PERIODS.items()]))
    asked = listed.select("ticker").distinct().select("ticker", label.alias("p")).select("ticker", "p.*", d.alias("end"))
    highs = range_highs(asked, close, blocks)
    picked = highs.groupBy("ticker").agg(
        *[F.max(F.when(F.col("label") == n, F.col(c))).alias(f"{c}_{n}") for n in HIGH_PERIODS for c in ("max_price", "max_price_date")]
    )
    week = close.filter(F.col("base_date").between(F.date_sub(d, VALUATION_LOOKBACK), d))
    recent = week.groupBy("ticker", "base_date").agg(F.max("price").alias("recent_price")).withColumnRenamed("base_date", "recent_price_date")
    j = listed.join(picked, "ticker", "left").join(recent, ["ticker", "recent_price_date"], "left")
    cols = [c for n in HIGH_PERIODS for c in (f"max_price_{n}", f"max_price_date_{n}")]
    return j.select("order_group", "order_index", "ticker", "asset_name", "recent_price_date", "recent_price", *cols, d.alias("base_date"))


def trailing_highs(close: DataFrame, blocks: DataFrame, days: int) -> DataFrame:
    """For every close: the highest one of its ticker in the ``days`` days up to it, and its earliest date."""
    asked = close.select("ticker", "base_date", F.date_sub("base_date", days - 1).alias("start"), F.col("base_date").alias("end"))
    return range_highs(asked, close, blocks).select("ticker", "base_date", "max_price", "max_price_date")


def entry_watch(entries: DataFrame, ticker_info: DataFrame, close: DataFrame, as_of: dt.date) -> DataFrame:
    """Per entry point: the recent close and whether it is at or below the entry level."""
    d = as_date(as_of)
    e = enrich(entries, ticker_info, "ticker", ["asset_name", "is_active_weekend"]).withColumn(
        "recent_price_date", valuation_date(d, "is_active_weekend")
    )
    px = close_on_valuation_date(close, ticker_info, as_of, ENTRY_LOOKBACK, out="recent_price")
    j = e.join(px, "ticker", "left")
    return j.select(
        (F.col("entry_price") >= F.col("recent_price")).alias("is_reached_entry_price"),
        "ticker",
        "asset_name",
        "add_date",
        "entry_price",
        "memo",
        "recent_price_date",
        "recent_price",
        d.alias("base_date"),
    )
