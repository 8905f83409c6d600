"""The daily job: build every model for one run and publish the incremental tables.

Order follows the model dependencies: staging views -> price history (published) -> positions
(published) -> marts (published, reading the published warehouse tables) -> checks. The trade
history, the largest input, is read three times per run: the FIFO columns of the buys for a bounded
sample, per-day flows shared by every aggregate, and the lots of the one group a key that its sells cut. Each
published table is a date-partitioned Parquet table under ``root`` updated with the keyed
partition upsert, so a re-run of the same dates is idempotent and a backfill is the same call
with wide run dates.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kabuto.operators import checks as Q
from kabuto.operators.ledger import cash_from_flows, net_from_flows, net_units, totals_from_flows, trade_flows
from kabuto.operators.lots import fifo_splitters, open_lots
from kabuto.operators.upsert import existing_table, read_table, table_missing, upsert_partitions
from kabuto.plans import marts, staging, warehouse
from kabuto.plans.declared import DECLARED
from kabuto.session import Scratch
from kabuto.sources.descriptions import describe
from kabuto.sources.schemas import RunDates

# Published tables: upsert key and partition column.
TABLES: dict[str, tuple[list[str], str]] = {
    "dwh_price_history": (["ticker", "base_date", "ohlc_type"], "base_date"),
    "dwh_daily_position": (["account", "ticker", "partition_date"], "partition_date"),
    "dm_daily_aum": (["account", "ticker", "partition_date"], "partition_date"),
    "dm_daily_position_value": (["account", "ticker", "partition_date"], "partition_date"),
    "dm_daily_all_term_pl": (["account", "ticker", "partition_date"], "partition_date"),
    "dm_daily_summary": (["ticker", "base_date"], "base_date"),
    "dm_max_price_monitor": (["ticker", "base_date"], "base_date"),
    "dm_watch_entry_point": (["ticker", "base_date"], "base_date"),
}
# One row per entry point: a ticker may carry several (even identical) entries, so no key is
# unique. Each run fully determines its base_date partition, which is replaced as a whole.
REPLACED = {"dm_watch_entry_point"}
# Marts with a row per open position: replaced along with the positions.
FROM_POSITIONS = {"dm_daily_aum", "dm_daily_position_value", "dm_daily_all_term_pl"}


def publish(spark: SparkSession, df: DataFrame, root: str, name: str, replace_partition: bool = False, partitions: Sequence = (), observed: Q.ObservedChecks | None = None) -> DataFrame:
    """Upsert ``df`` into table ``name`` under ``root`` and return the published table. A table that
    is replaced loses its rows in ``partitions`` even where ``df`` has none. ``observed`` counts its checks
    in what is written."""
    keys, part = TABLES[name]
    path = f"{root.rstrip('/')}/{name}"
    df = describe(df)
    df = df if observed is None else observed.observe(df)
    replace = replace_partition or name in REPLACED
    written = upsert_partitions(spark, df, path, keys, part, replace_partition=replace, check_unique=name not in REPLACED, partitions=partitions if replace else ())
    if not written and table_missing(spark, path, df.schema):
        return spark.createDataFrame([], df.schema)
    return read_table(spark, path, df.schema).select(*df.columns)


def register_views(spark: SparkSession, raw: Mapping[str, DataFrame], root: str | None = None) -> dict[str, DataFrame]:
    """Register the view models as Spark temp views (lazy; nothing runs until queried):
    the four staging views, the asset master and the mirrored cash ledger, and, when ``root``
    holds a published price history, the close-price view over it."""
    tickers = raw["ref_ticker_info"]
    trades = staging.stg_trade_history(raw["raw_trade_history"])
    status = staging.stg_asset_status_history(raw["raw_asset_status_history"])
    views = {
        "stg_price_data": staging.stg_price_data(raw["raw_price_data"]),
        "stg_trade_history": trades,
        "stg_asset_status_history": status,
        "stg_entry_point": staging.stg_entry_point(raw["raw_entry_point"]),
        "dwh_asset_master": warehouse.asset_master(status, tickers),
        "dwh_trade_history_with_cash": warehouse.trade_history_with_cash(trades),
    }
    if root is not None:
        views["dwh_close_price_history"] = warehouse.close_price_history(read_published(spark, root, "dwh_price_history"))
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    found = existing_table(spark, f"{root.rstrip('/')}/{name}")
    if found is None:
        raise ValueError(f"table {name} is not published under {root}; select it in this run")
    return found


def run_daily(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    dates: RunDates,
    root: str,
    run_checks: bool = True,
    replace_positions: bool = False,
    select: Iterable[str] | None = None,
    check_all_partitions: bool = False,
) -> dict[str, DataFrame]:
    """Run the models for ``dates``; ``raw`` holds the raw feeds and dimensions by table name
    (see ``kabuto.sources.raw.raw_sources``). Returns the published tables (and ``checks``).

    ``select`` limits the run to some published tables (default: all); the others a selected
    mart depends on are read as already published, not rebuilt. Checks cover the partitions
    this run wrote (earlier ones were checked by earlier runs); ``check_all_partitions`` checks
    the whole tables instead.
    """
    sel = set(select) if select is not None else set(TABLES)
    if sel - set(TABLES):
        raise ValueError(f"unknown tables: {sorted(sel - set(TABLES))}")
    with Scratch(spark) as scratch:
        return _run(spark, scratch, raw, dates, root, run_checks, replace_positions, sel, select is not None, check_all_partitions)


def _run(spark: SparkSession, scratch: Scratch, raw: Mapping[str, DataFrame], dates: RunDates, root: str, run_checks: bool, replace_positions: bool, sel: set[str], only: bool, check_all_partitions: bool) -> dict[str, DataFrame]:
    as_of = dates.as_of
    tickers = raw["ref_ticker_info"]
    trades = staging.stg_trade_history(raw["raw_trade_history"])
    out: dict[str, DataFrame] = {}
    observed: dict[str, Q.ObservedChecks] = {}

    def watch(name: str, failures=None) -> Q.ObservedChecks | None:
        if not run_checks or check_all_partitions or name not in DECLARED:
            return None
        observed[name] = Q.ObservedChecks(DECLARED[name], name, failures)
        return observed[name]

    def table(name: str, build, replace: bool = False) -> DataFrame:
        if name not in out:
            out[name] = publish(spark, build(), root, name, replace, [as_of], watch(name)) if name in sel else read_published(spark, root, name)
        return out[name]

    flow_cache: list[DataFrame] = []
    lot_splitters = fifo_splitters(trades, as_of, tie_break=warehouse.TRADE_TIE_BREAK) if "dwh_daily_position" in sel else None

    def flows() -> DataFrame:
        # One scan of the trade history into per-(account, ticker, day) flows, shared by every
        # aggregate consumer (written, so computed once); its checks are counted on the way.
        if not flow_cache:
            seen = trades
            for name, failures in (("stg_trade_history", None), ("dwh_trade_history_with_cash", _mirrored_failures())):
                if not only and (checks := watch(name, failures)) is not None:
                    seen = checks.observe(seen)
            flow_cache.append(scratch.write(trade_flows(seen, as_of, splitters=lot_splitters), "flows"))
        return flow_cache[0]

    def prices() -> DataFrame:
        return table("dwh_price_history", lambda: warehouse.price_history(staging.price_rows(raw["raw_price_data"]), tickers, dates))

    def close() -> DataFrame:
        return warehouse.close_price_history(prices())

    def positions() -> DataFrame:
        return table(
            "dwh_daily_position",
            lambda: open_lots(trades, as_of, tie_break=warehouse.TRADE_TIE_BREAK, flows=flows(), splitters=lot_splitters),
            replace_positions,
        )

    marts_built = {
        "dm_daily_aum": lambda: marts.aum(trades, positions(), tickers, close(), as_of, cash=cash_from_flows(flows(), out="current_value")),
        "dm_daily_position_value": lambda: marts.position_value(positions(), tickers, close(), as_of),
        "dm_daily_all_term_pl": lambda: marts.all_term_pl(trades, positions(), tickers, close(), as_of, totals=totals_from_flows(flows())),
        "dm_daily_summary": lambda: marts.daily_summary(raw["dim_summary_ticker_list"], tickers, prices(), as_of),
        "dm_max_price_monitor": lambda: marts.period_high(raw["dim_max_price"], tickers, close(), as_of),
        "dm_watch_entry_point": lambda: marts.entry_watch(staging.stg_entry_point(raw["raw_entry_point"]), tickers, close(), as_of),
    }
    if "dwh_price_history" in sel:
        prices()
    if "dwh_daily_position" in sel:
        positions()
    for name, build in marts_built.items():
        if name in sel:
            table(name, build, replace_positions and name in FROM_POSITIONS)
    out["dwh_asset_master"] = warehouse.asset_master(staging.stg_asset_status_history(raw["raw_asset_status_history"]), tickers)

    if run_checks:
        net = net_from_flows(flows()) if "dwh_daily_position" in sel else None
        written = {k: v for k, v in out.items() if k in sel}
        if not check_all_partitions:
            written = {k: _written_partitions(v, k, dates) for k, v in written.items()}
        named = sel | {"ref_ticker_info", "dim_summary_ticker_list"} if only else None
        out["checks"] = scratch_free(spark, daily_checks(raw, written, net, dates, named, observed))
    return out


def scratch_free(spark: SparkSession, results: DataFrame) -> DataFrame:
    """The check results (a row a check) as a table of their own, which needs nothing that was read."""
    return spark.createDataFrame(results.collect(), results.schema)


def _mirrored_failures() -> dict[Q.Check, Column]:
    """The checks of the mirrored cash ledger, counted on the trades: of each trade itself, and of the cash leg
    that a trade of another ticker gets (whose ticker, side and price are never NULL)."""
    own = {c.column: F.col(c.column).isNull() for c in DECLARED["dwh_trade_history_with_cash"]}
    leg = own | {c: F.lit(False) for c in ("ticker", "trade_type", "price")} | {"order_count": F.col("price").isNull() | F.col("order_count").isNull()}
    mirrored = F.col("ticker") != "cash"
    return {c: F.count(F.when(own[c.column], 1)) + F.count(F.when(mirrored & leg[c.column], 1)) for c in DECLARED["dwh_trade_history_with_cash"] if c.kind == "not_null"}


def _written_partitions(df: DataFrame, name: str, dates: RunDates) -> DataFrame:
    part = F.col(TABLES[name][1])
    if name == "dwh_price_history":
        return df.filter(part.between(F.lit(dates.update_from), F.lit(dates.as_of)))
    return df.filter(part == F.lit(dates.as_of))


def check_published(spark: SparkSession, raw: Mapping[str, DataFrame], dates: RunDates, root: str, select: Iterable[str] | None = None, all_partitions: bool = False) -> DataFrame:
    """The declared checks as a run of their own, over tables as published (nothing is built);
    ``select`` names tables or views, default all that are there."""
    names = set(select) if select is not None else None
    if names is not None and names - set(DECLARED) - set(TABLES):
        raise ValueError(f"unknown tables: {sorted(names - set(DECLARED) - set(TABLES))}")
    tables = {}
    for name in TABLES:
        if names is None or name in names:
            found = existing_table(spark, f"{root.rstrip('/')}/{name}")
            if found is not None:
                tables[name] = found if all_partitions else _written_partitions(found, name, dates)
            elif names is not None:
                raise ValueError(f"table {name} is not published under {root}")
    net = None
    if "dwh_daily_position" in tables:
        net = net_units(staging.stg_trade_history(raw["raw_trade_history"]), dates.as_of)
    return daily_checks(raw, tables, net, dates, names)


def daily_checks(raw: Mapping[str, DataFrame], t: Mapping[str, DataFrame], net: DataFrame | None, dates: RunDates, select: Iterable[str] | None = None, observed: Mapping[str, Q.ObservedChecks] | None = None) -> DataFrame:
    """The declared column checks of the dimensions, the views and the given published tables
    (``select``: only these names) plus, with ``net``, the position reconciliation (as a check row
    counting mismatching keys). Checks that were ``observed`` while a table was written are taken from
    there; of the price feed, then, the days that the run read are checked, not all that ever came."""
    observed = observed or {}
    d = dates.as_of
    trades = staging.stg_trade_history(raw["raw_trade_history"])
    views = {
        "ref_ticker_info": raw["ref_ticker_info"],
        "dim_summary_ticker_list": raw["dim_summary_ticker_list"],
        "stg_asset_status_history": staging.stg_asset_status_history(raw["raw_asset_status_history"]),
        "stg_trade_history": trades,
        "stg_price_data": staging.price_rows(raw["raw_price_data"]),
        "stg_entry_point": staging.stg_entry_point(raw["raw_entry_point"]),
        "dwh_trade_history_with_cash": warehouse.trade_history_with_cash(trades),
    }
    views["dwh_asset_master"] = warehouse.asset_master(views["stg_asset_status_history"], raw["ref_ticker_info"])
    known = {**views, **t}
    wanted = [name for name in DECLARED if name in known and (select is None or name in select)]
    if observed:
        known["stg_price_data"] = known["stg_price_data"].filter(F.col("base_date").between(F.lit(dates.history_from), F.lit(d)))
    parts = [observed[name].results(trades.sparkSession) for name in wanted if name in observed]
    parts += [Q.run_checks(known[name], left, name) for name in wanted if (left := observed[name].rest if name in observed else DECLARED[name])]
    if net is not None and "dwh_daily_position" in t:
        mismatches = Q.net_position_mismatches(t["dwh_daily_position"], net, d)
        parts.append(
            mismatches.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
                F.lit("dwh_daily_position").alias("table_name"),
                F.lit("matches_net").alias("check_name"),
                F.lit("position").alias("column_name"),
                F.lit("error").alias("severity"),
                F.lit("dwh_daily_position").alias("tags"),
                "failures",
            )
        )
    if not parts:
        return raw["ref_ticker_info"].sparkSession.createDataFrame([], Q.RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
