"""Ad-hoc reports (checks by eye of the warehouse and marts). Each returns a lazy DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.functions.columns import as_date, prev_weekday
from kabuto.operators.ranks import with_position
from kabuto.plans.marts import daily_summary
from kabuto.plans.warehouse import latest_prices
from kabuto.sources.schemas import CROSS_RATE_PAIRS

# Calendar bounds of the full-history price check.
CHECK_CALENDAR = (dt.date(2000, 1, 1), dt.date(2050, 12, 31))
FRIDAY = 6


def price_check_history(stg_prices: DataFrame) -> DataFrame:
    """Full price history on a daily calendar where a weekend day without its own price takes
    the Friday before (price and fetch time each fall back separately); days with neither are
    left out. Rows without a ticker or type are left out, as they match no key.

    Instead of densifying every key over the whole calendar, joining it twice and discarding
    empty days, each latest row emits its own day and, for a Friday, a fallback entry for the
    Saturday and Sunday after it; one aggregate per (ticker, ohlc_type, day) then picks own value
    first. Same rows, no join.
    """
    lo, hi = CHECK_CALENDAR
    keyed = stg_prices.where(F.col("ticker").isNotNull() & F.col("ohlc_type").isNotNull())
    latest = latest_prices(keyed).select("base_date", "ticker", "ohlc_type", "price", "fetch_time_jst")
    d = F.col("base_date")
    val = F.struct(F.col("price").alias("p"), F.col("fetch_time_jst").alias("t"))

    def entry(day, own: bool):
        return F.struct(day.alias("day"), F.lit(own).alias("own"), val.alias("v"))

    entries = F.when(
        F.dayofweek(d) == FRIDAY, F.array(entry(d, True), entry(F.date_add(d, 1), False), entry(F.date_add(d, 2), False))
    ).otherwise(F.array(entry(d, True)))
    rows = (
        latest.select("ticker", "ohlc_type", F.explode(entries).alias("e"))
        .select("ticker", "ohlc_type", "e.*")
        .filter(F.col("day").between(F.lit(lo), F.lit(hi)))
    )
    picked = rows.groupBy("ticker", "ohlc_type", "day").agg(
        F.max(F.when(F.col("own"), F.col("v"))).alias("_own"), F.max(F.when(~F.col("own"), F.col("v"))).alias("_fri")
    )
    return picked.select(
        F.col("day").alias("base_date"),
        "ticker",
        "ohlc_type",
        F.coalesce("_own.p", "_fri.p").alias("price"),
        F.coalesce("_own.t", "_fri.t").alias("fetch_time_jst"),
    ).filter(F.col("price").isNotNull())


def price_check_report(stg_prices: DataFrame, from_date: dt.date, as_of: dt.date, filter_all_arms: bool = False) -> DataFrame:
    """Price history check with derived cross rates (rounded to whole units).

    As in the original report, the closing date filter binds only to the last union arm (the
    second cross rate); ``filter_all_arms=True`` applies it to the whole union instead.
    """
    daily = price_check_history(stg_prices)
    # One pass over the legs: each close price goes to the pairs it is the base or the quote of.
    parts = F.array(*[F.struct(F.lit(out).alias("pair"), F.lit(leg).alias("leg"), F.lit(side).alias("side")) for base, quote, out in CROSS_RATE_PAIRS for leg, side in ((base, "base"), (quote, "quote"))])
    legs = daily.filter(F.col("ohlc_type") == "close").withColumn("p", F.explode(F.filter(parts, lambda x: x["leg"] == F.col("ticker"))))
    price = lambda side: F.max(F.when(F.col("p.side") == side, F.col("price")))
    rates = legs.groupBy(F.col("p.pair").alias("ticker"), "base_date").agg(
        F.round(price("base") * price("quote"), 0).alias("price"), F.max("fetch_time_jst").alias("fetch_time_jst")
    )
    rates = rates.withColumn("ohlc_type", F.lit("close")).select(*daily.columns)
    window = F.col("base_date").between(as_date(from_date), as_date(as_of)) & (F.col("ohlc_type") == "close")
    if filter_all_arms:
        out = daily.unionByName(rates).filter(window)
    else:
        out = daily.unionByName(rates.filter((F.col("ticker") != CROSS_RATE_PAIRS[-1][2]) | window))
    return out.orderBy("ticker", "base_date")


def position_value_check(positions: DataFrame, prices: DataFrame, master: DataFrame, as_of: dt.date) -> DataFrame:
    """Position value priced on the as-of date itself (no weekend rollback), attributes from the
    asset master."""
    d = as_date(as_of)
    px = prices.filter((F.col("base_date") == d) & (F.col("ohlc_type") == "close")).select("ticker", F.col("price").alias("close_price"))
    pos = positions.filter(F.col("partition_date") == d)
    j = pos.join(px, "ticker", "left").join(master.select("ticker", "asset_type", "asset_name"), "ticker", "left")
    gain = F.col("close_price") - F.col("avg_buy_price")
    return j.select(
        "account",
        "ticker",
        "asset_type",
        "asset_name",
        "position",
        "avg_buy_price",
        "close_price",
        (gain * F.col("position")).alias("unrealized_value"),
        (gain / F.col("avg_buy_price")).alias("unrealized_return_ratio"),
        d.alias("partition_date"),
    )


def daily_summary_report(ticker_list: DataFrame, ticker_info: DataFrame, prices: DataFrame, as_of: dt.date) -> DataFrame:
    return daily_summary(ticker_list, ticker_info, prices, as_of).orderBy("order_group", "order_index")


def weekday_price_report(prices: DataFrame, from_date: dt.date, as_of: dt.date) -> DataFrame:
    """Close prices in [from_date, as_of] with the weekday each date rolls back to."""
    rows = prices.filter(F.col("base_date").between(as_date(from_date), as_date(as_of)) & (F.col("ohlc_type") == "close"))
    return rows.select(
        "ticker", "base_date", prev_weekday("base_date").alias("adjusted_date"), "ohlc_type", "price"
    ).orderBy(F.col("ticker"), F.col("base_date").desc())


# The order that each report is shown in, made total.
REPORT_ORDER = {
    "daily_summary": ["order_group", "order_index", "ticker"],
    "price_check": ["ticker", "base_date", "ohlc_type"],
    "weekday_price": ["ticker", "-base_date"],
}


def ranked(report: DataFrame, name: str) -> DataFrame:
    """A report with every row's position in its order."""
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in REPORT_ORDER[name]]
    return with_position(report, order)
