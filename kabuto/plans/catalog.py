"""Registered queries: every model, report and check run over the driver's test tables.

Each entry takes (spark, sf_dir) and returns a DataFrame. ``duckdb_oracle.py`` holds the matching
DuckDB SQL for each name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kabuto.functions.columns import add_months_back, prev_weekday
from kabuto.operators import checks as Q
from kabuto.operators.ledger import cash_from_flows, net_units, totals_from_flows
from kabuto.operators.ledger_state import flows_at, open_lots_at, update_ledger
from kabuto.operators.range_max import block_maxima
from kabuto.operators.series import cross_rates
from kabuto.operators.upsert import read_table, upsert_partitions
from kabuto.plans import marts, reports, staging, warehouse
from kabuto.plans.daily import TABLES, run_daily
from kabuto.plans.declared import DECLARED
from kabuto.session import scratch_path
from kabuto.sources import fixtures as X
from kabuto.sources.descriptions import described, register_tables
from kabuto.sources.raw import read_quarantined
from kabuto.sources.schemas import CROSS_RATE_PAIRS, FILL_MAX_ROWS, RunDates

# Earlier run used by the upsert query (the later run is X.PRICE_DATES).
PRICE_DATES_PREVIOUS = RunDates(dt.date(2024, 1, 27), dt.date(2024, 1, 25), dt.date(2023, 12, 31))
REPORT_FROM = dt.date(2024, 1, 21)  # "7 days ago" of the report runs


class Inputs:
    """Staged inputs for one test-data directory. Each frame is built once per query, so a query
    that needs the trades twice plans the same subtree twice (Spark can reuse its exchanges) and
    the Parquet footers are read once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = X.projected(self.spark, self.sf_dir, name)
        return self._raw[name]

    def landed(self, name: str) -> DataFrame:
        """From now on feed ``name`` is read from a table of its own, written once: for queries that read a feed
        many times, whose projection is a join of test tables (the same rows)."""
        self._raw[name] = landed(self.spark, self.raw(name), name)
        return self._raw[name]

    @cached_property
    def prices(self) -> DataFrame:
        return staging.stg_price_data(self.raw("raw_price_data"))

    @cached_property
    def price_rows(self) -> DataFrame:
        return staging.price_rows(self.raw("raw_price_data"))

    @cached_property
    def trades(self) -> DataFrame:
        return staging.stg_trade_history(self.raw("raw_trade_history"))

    @cached_property
    def status(self) -> DataFrame:
        return staging.stg_asset_status_history(self.raw("raw_asset_status_history"))

    @cached_property
    def entries(self) -> DataFrame:
        return staging.stg_entry_point(self.raw("raw_entry_point"))

    @cached_property
    def tickers(self) -> DataFrame:
        # One object per query so its size check for broadcasting runs once.
        return self.raw("ref_ticker_info")

    def price_history(self, dates: RunDates = X.PRICE_BACKFILL) -> DataFrame:
        return warehouse.price_history(self.price_rows, self.tickers, dates)

    def close(self, dates: RunDates = X.PRICE_BACKFILL) -> DataFrame:
        return warehouse.close_price_history(self.price_history(dates))

    def positions(self, as_of: dt.date = X.POSITION_AS_OF) -> DataFrame:
        return warehouse.daily_position(self.trades, as_of)


def landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, f"landed-{name}")
    df.write.parquet(path)
    return read_table(spark, path, df.schema)


def prev_weekday_dates(i: Inputs) -> DataFrame:
    d = F.col("base_date")
    return (
        i.prices.select("base_date")
        .distinct()
        .select(
            "base_date",
            F.dayofweek(d).alias("day_of_week"),
            prev_weekday(d).alias("prev_weekday"),
            prev_weekday(F.date_sub(d, 7)).alias("prev_weekday_7day_ago"),
            add_months_back(d, 3).alias("date_3month_ago"),
            add_months_back(d, 12).alias("date_1year_ago"),
        )
    )


def cross_rate_series(i: Inputs) -> DataFrame:
    dates = X.PRICE_DATES
    filled = warehouse.filled_prices(i.price_rows, i.tickers, dates)
    return cross_rates(filled, CROSS_RATE_PAIRS, FILL_MAX_ROWS)


def price_upsert(i: Inputs) -> DataFrame:
    """Two consecutive daily runs of the price history published into one partitioned table."""
    path = scratch_path(i.spark, "price_history")
    keys = warehouse.PRICE_KEYS
    first = i.price_history(PRICE_DATES_PREVIOUS)
    upsert_partitions(i.spark, first, path, keys, "base_date")
    second = i.price_history(X.PRICE_DATES)
    upsert_partitions(i.spark, second, path, keys, "base_date")
    return read_table(i.spark, path, first.schema).select(*first.columns)


# The raw price feed arrives in two batches split at this date (every row arrives once).
STREAM_SPLIT = dt.date(2024, 1, 20)


def streaming_price_history(i: Inputs) -> DataFrame:
    """The raw price feed lands as files in two batches; the streaming driver picks each up
    (availableNow) and upserts the recomputed price history. Returns the published table."""
    from kabuto.streaming import price_history_batch_handler, raw_price_stream, run_incremental

    base = scratch_path(i.spark, "stream")
    feed, root, ckpt = f"{base}/raw", f"{base}/tables", f"{base}/ckpt"
    raw = i.raw("raw_price_data")
    handler = price_history_batch_handler(i.spark, feed, i.tickers, root)
    for batch in [raw.filter(F.col("date") <= STREAM_SPLIT), raw.filter(~(F.col("date") <= STREAM_SPLIT) | F.col("date").isNull())]:
        batch.write.mode("append").parquet(feed)
        run_incremental(raw_price_stream(i.spark, feed), handler, ckpt).awaitTermination()
    return i.spark.read.parquet(f"{root}/dwh_price_history").select("base_date", "ticker", "ohlc_type", "price", "fetch_time_jst")


# The trade log arrives in two batches: what is dated up to here (but for a tenth of the last month,
# which comes late), then the rest.
LEDGER_SPLIT = dt.date(1997, 6, 30)


def arrivals(trades: DataFrame) -> list[DataFrame]:
    late = (F.pmod(F.xxhash64("memo"), F.lit(10)) == 0) & (F.col("trade_date") > F.date_sub(F.lit(LEDGER_SPLIT), 30))
    first = (F.col("trade_date") <= LEDGER_SPLIT) & ~late
    return [trades.filter(first), trades.filter(~first | F.col("trade_date").isNull())]


def _ledger(i: Inputs) -> str:
    """The ledger tables after both arrivals. Every run and the positions read the trades again, so the feed
    is written once."""
    i.landed("raw_trade_history")
    root, seen = scratch_path(i.spark, "ledger"), None
    for batch in arrivals(i.trades):
        seen = batch if seen is None else i.trades
        update_ledger(i.spark, seen, batch, root)
    return root


def _positions_from(i: Inputs, root: str) -> DataFrame:
    return open_lots_at(i.spark, i.trades, root, X.POSITION_AS_OF, tie_break=warehouse.TRADE_TIE_BREAK)


def open_lots_incremental(i: Inputs) -> DataFrame:
    """Positions from the ledger tables, of which two runs have brought in the trades."""
    return _positions_from(i, _ledger(i))


def aum_incremental(i: Inputs) -> DataFrame:
    root = _ledger(i)
    cash = cash_from_flows(flows_at(i.spark, root, X.POSITION_AS_OF), out="current_value")
    return marts.aum(i.trades, _positions_from(i, root), i.tickers, i.close(), X.POSITION_AS_OF, cash=cash)


def all_term_pl_incremental(i: Inputs) -> DataFrame:
    root = _ledger(i)
    totals = totals_from_flows(flows_at(i.spark, root, X.POSITION_AS_OF))
    return marts.all_term_pl(i.trades, _positions_from(i, root), i.tickers, i.close(), X.POSITION_AS_OF, totals=totals)


def quarantine(i: Inputs) -> DataFrame:
    """The entry points landed as CSV, one record in thirteen with a price that is no number and one in
    seventeen with a field too many: what is read, and what is set aside and why."""
    base = scratch_path(i.spark, "landed")
    key = F.col("p_partkey")
    price = F.when(key % 13 == 0, F.lit("n/a")).otherwise((F.col("p_size") * F.lit(8.0)).cast("string"))
    memo = F.concat(F.lit("part "), key.cast("string"), F.when(key % 17 == 0, F.lit(",more")).otherwise(F.lit("")))
    lines = X._t(i.spark, i.sf_dir, "part").select(F.concat_ws(",", F.lit("2024-01-02"), X.ticker_of(key % 40), price, memo).alias("value"))
    lines.write.option("lineSep", "\n").text(f"{base}/raw_entry_point")
    read = read_quarantined(i.spark, base, "raw_entry_point", header=False)
    none = F.lit(None).cast("string")
    good = read.good.select("add_date", "ticker", "entry_price", "memo", none.alias("record"), none.alias("reason"))
    bad = read.bad.select(F.lit(None).cast("date").alias("add_date"), none.alias("ticker"), F.lit(None).cast("double").alias("entry_price"), none.alias("memo"), "record", "reason")
    return good.unionByName(bad)


def catalog_descriptions(i: Inputs) -> DataFrame:
    """The published tables of a daily run in the session catalog: every table and column with its comment."""
    root = scratch_path(i.spark, "catalog")
    run_daily(i.spark, X.load(i.spark, i.sf_dir), X.PRICE_DATES, root, run_checks=False)
    register_tables(i.spark, {name: f"{root}/{name}" for name in TABLES})
    return described(i.spark, TABLES)


def quality_checks(i: Inputs) -> DataFrame:
    """All declared column checks, over the dimensions, the staging, warehouse and mart tables.

    What several tables are made of (the trades, the positions, the filled prices) is written once."""
    i.landed("raw_trade_history")
    pos = landed(i.spark, i.positions(), "positions")
    history = landed(i.spark, i.price_history(), "price_history")
    close, as_of = warehouse.close_price_history(history), X.POSITION_AS_OF
    tables = {
        "ref_ticker_info": i.tickers,
        "dim_summary_ticker_list": i.raw("dim_summary_ticker_list"),
        "stg_asset_status_history": i.status,
        "stg_trade_history": i.trades,
        "stg_price_data": i.price_rows,
        "stg_entry_point": i.entries,
        "dwh_trade_history_with_cash": warehouse.trade_history_with_cash(i.trades),
        "dwh_asset_master": warehouse.asset_master(i.status, i.tickers),
        "dwh_price_history": i.price_history(X.PRICE_DATES),
        "dwh_daily_position": pos,
        "dm_daily_aum": marts.aum(i.trades, pos, i.tickers, close, as_of),
        "dm_daily_position_value": marts.position_value(pos, i.tickers, close, as_of),
        "dm_daily_all_term_pl": marts.all_term_pl(i.trades, pos, i.tickers, close, as_of),
        "dm_daily_summary": marts.daily_summary(i.raw("dim_summary_ticker_list"), i.tickers, history, as_of),
        "dm_watch_entry_point": marts.entry_watch(i.entries, i.tickers, close, as_of),
    }
    raw = Q.run_checks(i.raw("raw_trade_history"), [Q.is_datetime("timestamp_jst", severity="warn", tags=("raw", "format"))], "raw_trade_history")
    for name, df in tables.items():
        raw = raw.unionByName(Q.run_checks(df, DECLARED[name], name))
    return raw


def net_position_check(i: Inputs) -> DataFrame:
    """Keys whose FIFO position differs from bought minus sold units (oversold keys)."""
    as_of = X.POSITION_CUTOFF
    return Q.net_position_mismatches(i.positions(as_of), net_units(i.trades, as_of), as_of)


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "stg_prices": lambda i: i.prices,
    "stg_trades": lambda i: i.trades,
    "stg_status": lambda i: i.status,
    "stg_entry_points": lambda i: i.entries,
    "prev_weekday_dates": prev_weekday_dates,
    "asset_master": lambda i: warehouse.asset_master(i.status, i.tickers),
    "latest_prices": lambda i: warehouse.latest_prices(i.price_rows),
    "price_history": lambda i: i.price_history(X.PRICE_DATES),
    "price_history_backfill": lambda i: i.price_history(X.PRICE_BACKFILL),
    "close_prices": lambda i: i.close(X.PRICE_DATES),
    "cross_rates": cross_rate_series,
    "trades_with_cash": lambda i: warehouse.trade_history_with_cash(i.trades),
    "open_lots": lambda i: i.positions(X.POSITION_AS_OF),
    "open_lots_cutoff": lambda i: i.positions(X.POSITION_CUTOFF),
    "open_lots_range": lambda i: warehouse.daily_position(i.trades, X.POSITION_AS_OF, split="range"),
    "open_lots_incremental": open_lots_incremental,
    "aum_incremental": aum_incremental,
    "all_term_pl_incremental": all_term_pl_incremental,
    "open_lots_units": lambda i: warehouse.daily_position_units(i.trades, X.POSITION_AS_OF),
    "position_value": lambda i: marts.position_value(i.positions(), i.tickers, i.close(), X.POSITION_AS_OF),
    "aum": lambda i: marts.aum(i.trades, i.positions(), i.tickers, i.close(), X.POSITION_AS_OF),
    "all_term_pl": lambda i: marts.all_term_pl(i.trades, i.positions(), i.tickers, i.close(), X.POSITION_AS_OF),
    "daily_summary": lambda i: marts.daily_summary(i.raw("dim_summary_ticker_list"), i.tickers, i.price_history(), X.POSITION_AS_OF),
    "daily_summary_report": lambda i: reports.daily_summary_report(i.raw("dim_summary_ticker_list"), i.tickers, i.price_history(), X.POSITION_AS_OF),
    "period_high": lambda i: marts.period_high(i.raw("dim_max_price"), i.tickers, i.raw("long_close"), X.HIGHS_AS_OF),
    "period_high_blocks": lambda i: marts.period_high_from_blocks(
        i.raw("dim_max_price"), i.tickers, i.raw("long_close"), block_maxima(i.raw("long_close")), X.HIGHS_AS_OF
    ),
    "trailing_highs": lambda i: marts.trailing_highs(i.raw("long_close"), block_maxima(i.raw("long_close")), 100),
    "entry_watch": lambda i: marts.entry_watch(i.entries, i.tickers, i.close(), X.POSITION_AS_OF),
    "price_check_report": lambda i: reports.price_check_report(i.price_rows, REPORT_FROM, X.POSITION_AS_OF),
    "position_value_check": lambda i: reports.position_value_check(
        i.positions(), i.price_history(), warehouse.asset_master(i.status, i.tickers), X.POSITION_AS_OF
    ),
    "weekday_price_report": lambda i: reports.weekday_price_report(i.price_history(), REPORT_FROM, X.POSITION_AS_OF),
    "daily_summary_ranked": lambda i: reports.ranked(QUERIES["daily_summary_report"](i), "daily_summary"),
    "price_check_ranked": lambda i: reports.ranked(QUERIES["price_check_report"](i), "price_check"),
    "weekday_price_ranked": lambda i: reports.ranked(QUERIES["weekday_price_report"](i), "weekday_price"),
    "quarantine": quarantine,
    "catalog_descriptions": catalog_descriptions,
    "price_upsert": price_upsert,
    "streaming_price_history": streaming_price_history,
    "quality_checks": quality_checks,
    "net_position_check": net_position_check,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, fn in QUERIES.items():
        def run(spark, sf_dir, _fn=fn):
            return _fn(Inputs(spark, sf_dir))

        run.__name__ = name
        out[name] = run
    return out
