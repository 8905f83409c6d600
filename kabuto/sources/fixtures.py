"""Projections of the driver's test tables onto the raw-feed schemas.

The driver ships TPC-H-like tables (``events``, ``lineitem``, ``orders``, ``part``, ``customer``).
These functions map them onto the raw feeds the models read, using whole tables so the work grows
with the scale factor. ``duckdb_oracle.py`` holds the same projections in DuckDB SQL.

Run dates used with these inputs:
  prices     as_of 2024-01-28 (a Sunday), update_from 2024-01-26, history_from 2024-01-01
  positions  as_of 2024-01-28; the cut-off case as_of 1995-09-30
  highs      as_of 1999-05-31 (month-end clamping)
"""

from __future__ import annotations

import datetime as dt
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kabuto.sources.schemas import RunDates

PRICE_DATES = RunDates(dt.date(2024, 1, 28), dt.date(2024, 1, 26), dt.date(2024, 1, 1))
# Marts value positions on a price table that was back-filled over the whole look-back.
PRICE_BACKFILL = RunDates.backfill(dt.date(2024, 1, 1), dt.date(2024, 1, 28))
POSITION_AS_OF = dt.date(2024, 1, 28)
POSITION_CUTOFF = dt.date(1995, 9, 30)
HIGHS_AS_OF = dt.date(1999, 5, 31)


def ticker_of(e: Column) -> Column:
    """Integer id -> ticker; ids 0, 1, 2 are the legs of the derived cross rates."""
    return (
        F.when(e == 0, F.lit("BTC-USD"))
        .when(e == 1, F.lit("ETH-USD"))
        .when(e == 2, F.lit("JPY=X"))
        .otherwise(F.concat(F.lit("U"), e.cast("string")))
    )


# Schemas of the driver's tables (only the columns read here); an explicit schema also spares
# the footer-reading job of schema inference.
DRIVER_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_size int",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_price_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per event; purchase events are landed twice (exact repeats in the feed)."""
    ev = _t(spark, sf_dir, "events")
    rows = ev.select(
        F.col("ts").cast("date").alias("date"),
        ticker_of(F.col("user_id")).alias("ticker"),
        F.when(F.col("event_type") == "view", "open")
        .when(F.col("event_type") == "click", "high")
        .when(F.col("event_type") == "signup", "low")
        .otherwise("close")
        .alias("ohlc_type"),
        F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("value")).cast("double").alias("price"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("fetch_time_str"),
        F.col("event_type"),
    )
    return rows.unionByName(rows.filter(F.col("event_type") == "purchase")).drop("event_type")


def _account(custkey: Column) -> Column:
    return F.concat(F.lit("A"), (custkey % 8).cast("string"))


def raw_trade_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as security trades (returned lines are sells) plus one cash movement per order."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    # A fact-to-fact join: shuffled on the order key (never broadcast; orders grows with lineitem).
    trades = li.join(od.hint("shuffle_hash"), li.l_orderkey == od.o_orderkey).select(
        F.date_format("l_shipdate", "yyyy/MM/dd HH:mm:ss").alias("timestamp_jst"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        ticker_of(F.col("l_partkey") % 20).alias("ticker"),
        F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("trade_type"),
        _account(F.col("o_custkey")).alias("account"),
        F.col("l_quantity").cast("bigint").alias("order_count"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_orderkey").cast("string").alias("memo"),
    )
    cash = od.select(
        F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss").alias("timestamp_jst"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.lit("cash").alias("ticker"),
        F.when(F.col("o_orderkey") % 5 == 0, "sell").otherwise("buy").alias("trade_type"),
        _account(F.col("o_custkey")).alias("account"),
        F.lit(1).cast("bigint").alias("order_count"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").cast("string").alias("memo"),
    )
    return trades.unionByName(cash)


def raw_asset_status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    return ev.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time_jst_str"),
        ticker_of(F.col("user_id")).alias("ticker"),
        (F.col("value") > 100).alias("is_monitor"),
        (F.col("event_type") == "purchase").alias("is_watch"),
    )


def raw_entry_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry level per part; every 11th has no add_date (dropped by staging)."""
    pt = _t(spark, sf_dir, "part")
    return pt.select(
        F.when(F.col("p_partkey") % 11 == 0, F.lit(None).cast("date"))
        .otherwise(F.lit(dt.date(2024, 1, 2)))
        .alias("add_date"),
        ticker_of(F.col("p_partkey") % 40).alias("ticker"),
        (F.col("p_size") * F.lit(8.0)).alias("entry_price"),
        F.col("p_name").alias("memo"),
    )


def ref_ticker_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker dimension: one row per customer; weekend flag TRUE / FALSE / NULL."""
    cu = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return cu.select(
        ticker_of(k).alias("ticker"),
        F.col("c_mktsegment").alias("asset_type"),
        F.col("c_name").alias("asset_name"),
        F.when(k < 2, F.lit(True)).when(k % 17 == 16, F.lit(None).cast("boolean")).otherwise(k % 3 == 0)
        .alias("is_active_weekend"),
    )


def _display_list(spark: SparkSession, sf_dir: str, groups: int) -> DataFrame:
    cu = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return cu.select(ticker_of(k).alias("ticker"), (k % groups).alias("order_group"), k.alias("order_index"))


def dim_summary_ticker_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _display_list(spark, sf_dir, 5)


def dim_max_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _display_list(spark, sf_dir, 4)


def long_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A multi-year close series (daily max order value per customer group) for period highs."""
    od = _t(spark, sf_dir, "orders")
    return (
        od.groupBy(F.col("o_orderdate").cast("date").alias("base_date"), ticker_of(F.col("o_custkey") % 10).alias("ticker"))
        .agg(F.max("o_totalprice").alias("price"))
        .select("base_date", "ticker", F.lit("close").alias("ohlc_type"), "price")
    )


FIXTURES = {
    "raw_price_data": raw_price_data,
    "raw_trade_history": raw_trade_history,
    "raw_asset_status_history": raw_asset_status_history,
    "raw_entry_point": raw_entry_point,
    "ref_ticker_info": ref_ticker_info,
    "dim_summary_ticker_list": dim_summary_ticker_list,
    "dim_max_price": dim_max_price,
    "long_close": long_close,
}


# The driver's tables are read-only, so a session can reuse each projection's DataFrame (plan
# analysis and the dimension's broadcast size check then happen once per session).
_SESSION_CACHE: "weakref.WeakKeyDictionary[SparkSession, dict[tuple[str, str], DataFrame]]" = weakref.WeakKeyDictionary()


def projected(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    per_session = _SESSION_CACHE.setdefault(spark, {})
    key = (sf_dir.rstrip("/"), name)
    if key not in per_session:
        per_session[key] = FIXTURES[name](spark, sf_dir)
    return per_session[key]


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: projected(spark, sf_dir, n) for n in FIXTURES}
