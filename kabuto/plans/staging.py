"""Staging: one cleaned view per raw feed (parse datetimes, rename, drop rows without a time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.functions.columns import DASH_DATETIME, SLASH_DATETIME, parse_datetime


def stg_asset_status_history(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("event_time_jst_str").isNotNull()).select(
        parse_datetime("event_time_jst_str", DASH_DATETIME).alias("event_time_jst"), "ticker", "is_monitor", "is_watch"
    )


def stg_trade_history(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("timestamp_jst").isNotNull()).select(
        parse_datetime("timestamp_jst", SLASH_DATETIME).alias("event_time_jst"),
        "trade_date",
        "ticker",
        "trade_type",
        "account",
        "order_count",
        "price",
        "memo",
    )


def price_rows(raw: DataFrame) -> DataFrame:
    """Cleaned price feed rows, exact repeats still in (the feed is appended on a schedule)."""
    return raw.filter(F.col("date").isNotNull()).select(
        F.col("date").alias("base_date"),
        "ticker",
        "ohlc_type",
        "price",
        parse_datetime("fetch_time_str", DASH_DATETIME).alias("fetch_time_jst"),
    )


def stg_price_data(raw: DataFrame) -> DataFrame:
    """Price feed without exact repeats. Consumers that keep one row per key anyway (latest
    fetch) may read ``price_rows`` and skip this DISTINCT shuffle: the result is the same."""
    return price_rows(raw).distinct()


def stg_entry_point(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("add_date").isNotNull()).select("add_date", "ticker", "entry_price", "memo")
