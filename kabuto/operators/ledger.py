"""Trade-ledger operators: mirrored cash movements and per-key trade totals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kabuto.functions.columns import MONEY, MONEY_REST, as_date, money_parts, money_sum, money_total
from kabuto.operators.lots import Splitters, lot_sums


def mirror_cash(
    trades: DataFrame,
    cash: str = "cash",
    instrument: str = "ticker",
    side: str = "trade_type",
    qty: str = "order_count",
    price: str = "price",
    buy: str = "buy",
    sell: str = "sell",
) -> DataFrame:
    """Every non-cash trade plus its cash leg: ticker=cash, opposite side (anything but a buy
    mirrors to a buy), quantity = price x quantity, price = 1. Cash trades pass through once.
    Quantity and price become DOUBLE."""
    base = trades.withColumn(qty, F.col(qty).cast(T.DoubleType())).withColumn(price, F.col(price).cast(T.DoubleType()))
    legs = (
        base.filter(F.col(instrument) != cash)
        .withColumn(instrument, F.lit(cash))
        .withColumn(side, F.when(F.col(side) == buy, F.lit(sell)).otherwise(F.lit(buy)))
        .withColumn(qty, F.col(price) * F.col(qty))
        .withColumn(price, F.lit(1.0))
    )
    return base.unionByName(legs)


def amount(qty: str = "order_count", price: str = "price"):
    return F.col(price) * F.col(qty)


def trade_totals(
    trades: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account", "ticker"),
    date_col: str = "trade_date",
    side: str = "trade_type",
    instrument: str = "ticker",
    exclude: str = "cash",
) -> DataFrame:
    """All-term bought and sold amounts per key up to ``as_of`` (NULL when a side has no trade)."""
    t = trades.filter((F.col(date_col) <= as_date(as_of)) & (F.col(instrument) != exclude))
    return t.groupBy(*keys).agg(
        money_sum(F.when(F.col(side) == "buy", amount())).alias("total_buy_amount"),
        money_sum(F.when(F.col(side) == "sell", amount())).alias("sell_amount_already"),
    )


def signed_balance(
    trades: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account", "ticker"),
    date_col: str = "trade_date",
    side: str = "trade_type",
    instrument: str = "ticker",
    only: str = "cash",
    out: str = "balance",
) -> DataFrame:
    """Signed amount per key up to ``as_of``: buys add, every other side subtracts."""
    t = trades.filter((F.col(date_col) <= as_date(as_of)) & (F.col(instrument) == only))
    signed = F.when(F.col(side) == "buy", amount()).otherwise(F.lit(-1) * amount())
    return t.groupBy(*keys).agg(money_sum(signed).alias(out))


def net_units(
    trades: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account", "ticker"),
    date_col: str = "trade_date",
    side: str = "trade_type",
    qty: str = "order_count",
    instrument: str = "ticker",
    exclude: str = "cash",
    out: str = "net_position",
) -> DataFrame:
    """Bought minus sold quantity per key up to ``as_of`` (every non-buy side subtracts)."""
    t = trades.filter((F.col(date_col) <= as_date(as_of)) & (F.col(instrument) != exclude))
    signed = F.when(F.col(side) == "buy", F.col(qty)).otherwise(F.lit(-1) * F.col(qty))
    return t.groupBy(*keys).agg(F.sum(signed).alias(out))


def cash_balance(
    trades: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account",),
    date_col: str = "trade_date",
    side: str = "trade_type",
    instrument: str = "ticker",
    cash: str = "cash",
    out: str = "balance",
) -> DataFrame:
    """Cash balance per account up to ``as_of`` of the ledger ``mirror_cash(trades)``, in one
    pass over ``trades`` (no union of the trades with their cash legs).

    A cash trade counts with its own sign (buy adds, anything else subtracts). Every other trade
    contributes its cash leg: the opposite side (a buy becomes a sell, anything else a buy) for
    price x quantity, i.e. a buy subtracts and anything else adds. Rows with a NULL ticker have
    no cash leg (``ticker != cash`` is not true for them), as in the mirrored ledger.
    """
    t = trades.filter(F.col(date_col) <= as_date(as_of))
    is_buy = F.col(side) == "buy"
    amt = amount()
    own = F.when(is_buy, amt).otherwise(F.lit(-1) * amt)
    leg = F.when(is_buy, F.lit(-1) * amt).otherwise(amt)
    delta = F.when(F.col(instrument) == cash, own).when(F.col(instrument) != cash, leg)
    has_cash = (F.col(instrument) == cash) | (F.col(instrument) != cash)
    return (
        t.filter(has_cash)
        .groupBy(*keys)
        .agg(money_sum(delta).alias(out))
        .withColumn(instrument, F.lit(cash))
        .select(*keys, instrument, out)
    )


def trade_flows(
    trades: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account", "ticker"),
    date_col: str = "trade_date",
    side: str = "trade_type",
    qty: str = "order_count",
    instrument: str = "ticker",
    cash: str = "cash",
    price: str = "price",
    splitters: Splitters | None = None,
) -> DataFrame:
    """Everything the daily marts need from the trade history, per (keys, day), in one scan:

      _buy_units / _sell_units  unit runs bought / sold (the groups of ``open_lots``)
      _lot_value, _lot_rest, _lot_wild, _priced_units  value of the bought units (``priced_parts``)
      _buy_amount / _sell_amount  price x quantity of buys / sells (exact DECIMAL, in two columns)
      _net_qty                  bought minus sold quantity (any non-buy side subtracts)
      _cash_delta               effect on the mirrored cash ledger (exact DECIMAL)

    Rows are one per key and trading day (with ``splitters``: per piece of a day, ``_piece``), so the table
    is small next to the trades; the key level results below sum it again (DECIMAL sums stay
    exact, so the totals are identical).
    """
    t = trades.filter(F.col(date_col) <= as_date(as_of))
    is_buy, is_sell = F.col(side) == "buy", F.col(side) == "sell"
    groups = [*keys, date_col]
    if splitters is not None:
        t = t.select("*", F.when(is_buy, splitters.piece()).otherwise(F.lit(0)).alias("_piece"))
        groups.append("_piece")
    amt = amount(qty)
    own = F.when(is_buy, amt).otherwise(F.lit(-1) * amt)
    leg = F.when(is_buy, F.lit(-1) * amt).otherwise(amt)
    return t.groupBy(*groups).agg(
        *lot_sums(qty, price, is_buy, is_sell),
        *_summed_parts(F.when(is_buy, amt), "_buy_amount"),
        *_summed_parts(F.when(is_sell, amt), "_sell_amount"),
        F.sum(F.when(is_buy, F.col(qty)).otherwise(F.lit(-1) * F.col(qty))).alias("_net_qty"),
        *_summed_parts(F.when(F.col(instrument) == cash, own).when(F.col(instrument) != cash, leg), "_cash_delta"),
    )


def _summed_parts(amt, name: str):
    high, rest = money_parts(amt)
    return F.sum(high).cast(MONEY).alias(name), F.sum(rest).cast(MONEY_REST).alias(f"{name}_rest")


def _money_total(c: str):
    return money_total(F.sum(F.col(c)).cast(MONEY), F.sum(F.col(f"{c}_rest")).cast(MONEY_REST))


def totals_from_flows(flows: DataFrame, keys: Sequence[str] = ("account", "ticker"), instrument: str = "ticker", cash: str = "cash") -> DataFrame:
    """``trade_totals`` from a ``trade_flows`` table."""
    return flows.filter(F.col(instrument) != cash).groupBy(*keys).agg(
        _money_total("_buy_amount").alias("total_buy_amount"), _money_total("_sell_amount").alias("sell_amount_already")
    )


def net_from_flows(flows: DataFrame, keys: Sequence[str] = ("account", "ticker"), instrument: str = "ticker", cash: str = "cash") -> DataFrame:
    """``net_units`` from a ``trade_flows`` table."""
    return flows.filter(F.col(instrument) != cash).groupBy(*keys).agg(F.sum("_net_qty").alias("net_position"))


def cash_from_flows(flows: DataFrame, account: str = "account", instrument: str = "ticker", cash: str = "cash", out: str = "balance") -> DataFrame:
    """``cash_balance`` from a ``trade_flows`` table (rows with a NULL ticker have no cash leg)."""
    return (
        flows.filter(F.col(instrument).isNotNull())
        .groupBy(account)
        .agg(_money_total("_cash_delta").alias(out))
        .select(account, F.lit(cash).alias(instrument), out)
    )
