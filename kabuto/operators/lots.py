"""First-in-first-out lot matching: what is still held after sells consume the oldest buys.

Semantics (long-only): every buy and sell is a run of ``quantity`` unit lots. Per key, units are
numbered in FIFO order on each side and the n-th buy unit is closed by the n-th sell unit. The
open position is the buy units numbered above the key's total sold units; its average price is
the mean unit price of those units (NULL prices ignored). A key whose position is zero (or that
is oversold) has no row.

Sells only ever move one boundary a key: what lies behind it in FIFO order is open as a whole, what lies
before it is closed as a whole, and one group of lots is cut. ``open_lots`` finds it by sums:

  1. per (key, day, piece of the day): units bought and sold, and the exact value of the bought
     units (partial aggregation, map-side; no trade row is shuffled)
  2. per key: a running sum over these groups finds the one group that the boundary cuts; the groups
     behind it are open and already summed
  3. only the lots of the cut groups are read again, one group a key, and numbered

A day is split where it is large: ``fifo_splitters`` takes a bounded sample of the lots in FIFO
order and keeps the quantiles that fall inside one day as literals, so the piece of a lot is a plain
expression of its columns, the same wherever it is computed. A (key, day) with a third of all rows falls
into a third of all pieces; equal lots are one row before anything is numbered. The cut groups also filter the
lots below their shuffle, by a broadcast table of bounded size (the span of the cut days for each hash
bucket of keys). ``open_lots_units`` is the literal form by unit numbers, kept to cross-check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kabuto.functions.columns import MONEY, PRICED_REST, as_date, money_sum, priced_parts, priced_total

PIECES = 64  # of the FIFO order of all lots
SAMPLE = 16  # sampled lots a piece
CUT_BUCKETS = 1 << 16  # rows of the broadcast filter, at most
UNIT_BLOCK = 1 << 12  # unit numbers that are matched at a time (a power of 2)


@dataclass(frozen=True)
class Splitters:
    """Boundaries inside days: rows of literals (as text, with their types; the day first) in FIFO order."""

    order: tuple[str, ...]
    types: tuple[str, ...] = ()
    rows: tuple[tuple[str | None, ...], ...] = ()

    def piece(self) -> Column:
        """The piece of its day that a row falls into: how many boundaries of the day lie at or before it
        (NULLs first). A tree of comparisons for a split day, 0 for all others."""
        day, rest = self.order[0], self.order[1:]
        here = F.struct(*[F.col(c).alias(c) for c in rest])

        def literal(row: tuple[str | None, ...]) -> Column:
            return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row[1:], self.types[1:], rest)])

        def among(rows, first: int) -> Column:
            if not rows:
                return F.lit(first)
            mid = len(rows) // 2
            return F.when(here >= literal(rows[mid]), among(rows[mid + 1 :], first + mid + 1)).otherwise(among(rows[:mid], first))

        out = F.lit(0)
        for d in {r[0]: None for r in self.rows}:
            out = F.when(F.col(day).eqNullSafe(F.lit(d).cast(self.types[0])), among([r for r in self.rows if r[0] == d], 0)).otherwise(out)
        return out


def _units(qty: str) -> Column:
    # A run of n unit lots; n < 1 or NULL is an empty run.
    return F.greatest(F.coalesce(F.col(qty).cast(T.LongType()), F.lit(0)), F.lit(0))


def _eligible(trades: DataFrame, as_of, date_col: str, instrument: str, exclude: Sequence[str]) -> DataFrame:
    cond = F.col(date_col) <= as_date(as_of)
    for x in exclude:
        cond = cond & (F.col(instrument) != F.lit(x))
    return trades.filter(cond)


def fifo_splitters(
    trades: DataFrame,
    as_of: dt.date,
    date_col: str = "trade_date",
    tie_break: Sequence[str] = ("memo", "price", "order_count"),
    side: str = "trade_type",
    buy: str = "buy",
    instrument: str = "ticker",
    exclude: Sequence[str] = ("cash",),
    pieces: int = PIECES,
) -> Splitters:
    """Quantiles of the FIFO order (``date_col``, then ``tie_break``) of all buys, from a bounded sample
    (``SAMPLE`` rows a piece, those of smallest hash): those that follow another one on the same day, so that
    only days with more than one piece's share of the lots are split. One pass over these
    columns; any splitters give the same positions."""
    order = [date_col, *tie_break]
    buys = _eligible(trades, as_of, date_col, instrument, exclude).filter(F.col(side) == buy).select(*order)
    if pieces < 2:
        return Splitters(tuple(order))
    some = buys.withColumn("_h", F.xxhash64(*order, F.monotonically_increasing_id())).orderBy("_h").limit(pieces * SAMPLE)
    rows = some.orderBy(*order).select(*[F.col(c).cast("string") for c in order]).collect()
    quantiles = [tuple(rows[len(rows) * k // pieces]) for k in range(pieces)] if rows else []
    inside = [b for a, b in zip(quantiles, quantiles[1:]) if a[0] == b[0] and a != b]
    return Splitters(tuple(order), tuple(buys.schema[c].dataType.simpleString() for c in order), tuple(inside))


def open_lots(
    trades: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account", "ticker"),
    date_col: str = "trade_date",
    tie_break: Sequence[str] = ("memo", "price", "order_count"),
    qty: str = "order_count",
    price: str = "price",
    side: str = "trade_type",
    buy: str = "buy",
    sell: str = "sell",
    instrument: str = "ticker",
    exclude: Sequence[str] = ("cash",),
    partition_col: str = "partition_date",
    split: str = "day",
    range_partitions: int | None = None,
    flows: DataFrame | None = None,
    splitters: Splitters | None = None,
) -> DataFrame:
    """Open long position per key at ``as_of``: (keys..., position, avg_buy_price, partition_date).

    FIFO order within a key is ``date_col`` then ``tie_break`` (give a total order).

    The lots are split into ``PIECES`` pieces of the FIFO order (``split="range"``: into
    ``range_partitions``, by default as many as shuffle partitions); the largest unit of work is
    one key's distinct lots in one piece of one day. ``splitters`` may be given (``fifo_splitters``), else they
    are taken from a sampling pass.

    ``flows`` may pass a precomputed ``ledger.trade_flows`` table for the same ``as_of`` (with the same
    ``splitters``, or with none); the trades are then only read for the lots of the cut groups.
    """
    keys = list(keys)
    if splitters is None:
        pieces = PIECES if split == "day" else range_partitions or int(trades.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if flows is not None:
            pieces = 1  # the flows are by day
        splitters = fifo_splitters(trades, as_of, date_col, tie_break, side, buy, instrument, exclude, pieces)
    t = _eligible(trades, as_of, date_col, instrument, exclude)
    if flows is None:
        flows = lot_flows(t, keys, date_col, qty, price, side, buy, sell, splitters)
    else:
        kept = F.lit(True)
        for x in exclude:
            kept = kept & (F.col(instrument) != F.lit(x))
        flows = flows.filter(kept)
        flows = flows if "_piece" in flows.columns else flows.withColumn("_piece", F.lit(0))

    # Sells never match a NULL key (its buys stay open), as in an equality join of unit numbers.
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    flows = _whole_rows(flows, ["_buy_units", "_sell_units", *LOT_VALUE], [*keys, date_col, "_piece"])
    per_key = Window.partitionBy("_k")
    groups = flows.select(F.struct(*[F.col(c) for c in keys]).alias("_k"), keyed.alias("_keyed"), F.col(date_col).alias("_d"), "_piece", F.coalesce("_buy_units", F.lit(0)).alias("_dq"), "_sell_units", *LOT_VALUE)
    sold = F.when(F.col("_keyed"), F.coalesce(F.sum("_sell_units").over(per_key), F.lit(0))).otherwise(F.lit(0))
    whole, cut = boundary(groups.withColumn("_gone", sold), ["_d", "_piece"])
    buys = buy_lots(t, keys, date_col, tie_break, qty, price, side, buy, splitters)
    return summed_lots(whole.unionByName(cut_lots(buys, cut, len(tie_break))), keys, as_of, partition_col)


LOT_VALUE = ["_lot_value", "_lot_rest", "_lot_wild", "_priced_units"]


def boundary(groups: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Where ``_gone`` sold units end among groups of lots (``_k``, ``order``, ``_dq`` units bought, value
    columns): the groups behind the boundary as (_k, _open, value), and the one group a key that it cuts
    as (_k, order, _gone: units of it that are gone)."""
    before = Window.partitionBy("_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_before", F.coalesce(F.sum("_dq").over(before), F.lit(0)))
    groups = groups.filter((F.col("_dq") > 0) & (F.col("_before") + F.col("_dq") > F.col("_gone")))
    whole = groups.filter(F.col("_before") >= F.col("_gone")).select("_k", F.col("_dq").alias("_open"), *LOT_VALUE)
    return whole, groups.filter(F.col("_before") < F.col("_gone")).select("_k", *order, (F.col("_gone") - F.col("_before")).alias("_gone"))


def buy_lots(t: DataFrame, keys: Sequence[str], date_col: str, tie_break: Sequence[str], qty: str, price: str, side: str, buy: str, splitters: Splitters) -> DataFrame:
    """The buys of ``t`` as (_k, _d, _piece, _tb0.., _px, _q). The key columns travel as one struct (struct
    equality matches NULL fields)."""
    buys = t.filter(F.col(side) == buy).select("*", splitters.piece().alias("_piece"))
    buys = buys.select(
        F.struct(*[F.col(c) for c in keys]).alias("_k"),
        F.col(date_col).alias("_d"),
        "_piece",
        *[F.col(c).alias(f"_tb{i}") for i, c in enumerate(tie_break)],
        F.col(price).alias("_px"),
        _units(qty).alias("_q"),
    )
    return buys.filter(F.col("_q") > 0)


def cut_lots(buys: DataFrame, cut: DataFrame, ties: int) -> DataFrame:
    """The open units of the lots in the ``cut`` groups (_k, _d, _piece, _gone), as (_k, _open, value). Equal
    lots are one row with their units before they are numbered."""
    tb = [f"_tb{i}" for i in range(ties)]
    lots = near_cut(buys, cut).groupBy("_k", "_d", "_piece", *tb, "_px").agg(F.sum("_q").alias("_q"))
    lots = lots.join(cut, ["_k", "_d", "_piece"])
    within = Window.partitionBy("_k", "_d", "_piece").orderBy(*tb, "_px").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.least(F.col("_q"), F.sum("_q").over(within) - F.col("_gone"))
    lots = lots.select("_k", "_px", left.alias("_open")).filter(F.col("_open") > 0)
    return lots.select("_k", "_open", *[c.alias(n) for c, n in zip(priced_parts("_px", "_open"), LOT_VALUE)])


def summed_lots(lots: DataFrame, keys: Sequence[str], as_of: dt.date, partition_col: str) -> DataFrame:
    """Position and mean price per key from (_k, _open, value) rows."""
    out = lots.groupBy("_k").agg(F.sum("_open").cast(T.LongType()).alias("position"), priced_total(*LOT_VALUE).alias("avg_buy_price"))
    return out.select(*[F.col(f"_k.{c}").alias(c) for c in keys], "position", "avg_buy_price").withColumn(partition_col, as_date(as_of))


def lot_flows(t: DataFrame, keys: Sequence[str], date_col: str, qty: str, price: str, side: str, buy: str, sell: str, splitters: Splitters) -> DataFrame:
    """Per (keys, day, piece): units bought and sold, and the exact value of the bought units."""
    is_buy = F.col(side) == buy
    rows = t.select("*", F.when(is_buy, splitters.piece()).otherwise(F.lit(0)).alias("_piece"))
    return rows.groupBy(*keys, date_col, "_piece").agg(*lot_sums(qty, price, is_buy, F.col(side) == sell))


def _whole_rows(df: DataFrame, columns: list[str], groups: list[str]) -> DataFrame:
    """``df``, with ``columns`` carried in one. The cut groups need some of the sums, the open ones all: with
    one column for them both read the same rows, so that Spark computes the aggregate once (its exchange
    is reused) where column pruning would make two different ones of it."""
    packed = df.select(*groups, F.array(*[F.col(c).cast("string") for c in columns]).alias("_s"))
    types = [df.schema[c].dataType for c in columns]
    return packed.select(*groups, *[F.element_at("_s", i + 1).cast(t).alias(c) for i, (c, t) in enumerate(zip(columns, types))])


def lot_sums(qty: str, price: str, is_buy: Column, is_sell: Column) -> list[Column]:
    units = _units(qty)
    high, rest, wild, priced = priced_parts(price, units)
    return [
        F.sum(F.when(is_buy, units)).alias("_buy_units"),
        F.sum(F.when(is_sell, units)).alias("_sell_units"),
        F.sum(F.when(is_buy, high)).cast(MONEY).alias("_lot_value"),
        F.sum(F.when(is_buy, rest)).cast(PRICED_REST).alias("_lot_rest"),
        F.sum(F.when(is_buy, wild)).alias("_lot_wild"),
        F.sum(F.when(is_buy, priced)).alias("_priced_units"),
    ]


def near_cut(buys: DataFrame, cut: DataFrame) -> DataFrame:
    """The lots that can lie in a cut group, found before they are shuffled: those on the days that the
    boundaries of the keys in their hash bucket span. The filter has ``CUT_BUCKETS`` rows at most."""
    bucket = F.pmod(F.xxhash64("_k"), F.lit(CUT_BUCKETS))
    days = cut.groupBy(bucket.alias("_b")).agg(F.min("_d").alias("_from"), F.max("_d").alias("_to"))
    # Null-safe, so that no filter is inferred for the other side and the aggregate below stays the shared one.
    near = buys.join(F.broadcast(days), bucket.eqNullSafe(F.col("_b")) & F.col("_d").between(F.col("_from"), F.col("_to")))
    return near.select(*buys.columns)


def _summarise(lots: DataFrame, keys: list[str], units: str, px: str, as_of, partition_col: str) -> DataFrame:
    priced = F.when(F.col(px).isNotNull(), F.col(units))
    return lots.groupBy(*keys).agg(
        F.sum(units).cast(T.LongType()).alias("position"),
        (money_sum(px, units) / F.sum(priced)).alias("avg_buy_price"),
    ).withColumn(partition_col, as_date(as_of))


def open_lots_units(
    trades: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account", "ticker"),
    date_col: str = "trade_date",
    tie_break: Sequence[str] = ("memo", "price", "order_count"),
    qty: str = "order_count",
    price: str = "price",
    side: str = "trade_type",
    buy: str = "buy",
    sell: str = "sell",
    instrument: str = "ticker",
    exclude: Sequence[str] = ("cash",),
    partition_col: str = "partition_date",
) -> DataFrame:
    """Literal form: every unit has its FIFO number on its side, and the n-th buy is removed by the n-th sell;
    nothing is taken from the sums of ``open_lots``. Use for checks.

    Numbers are handed out to whole runs and matched in blocks of ``UNIT_BLOCK`` numbers: a block that sells fill
    takes its buys away as runs, one without sells leaves them as runs, and where sells end inside a block
    its units become rows (``explode(sequence)``, anti join), at most one block a key. Rows grow with the trades
    and with the quantity divided by the block, not with the quantity."""
    keys = list(keys)
    t = _eligible(trades, as_of, date_col, instrument, exclude).filter(F.col(side).isin(buy, sell))
    t = t.withColumn("_q", _units(qty)).filter(F.col("_q") >= 1)
    w = Window.partitionBy(*keys, side).orderBy(date_col, *tie_break).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("_to", F.sum("_q").over(w)).withColumn("_from", F.col("_to") - F.col("_q"))  # numbers from 0
    block = F.explode(F.sequence(_block_of(F.col("_from")), _block_of(F.col("_to") - 1)))
    t = t.select(*keys, F.col(side).alias("_side"), F.col(price).alias("_px"), "_from", "_to", block.alias("_b"))
    t = t.withColumn("_from", F.greatest("_from", F.col("_b") * UNIT_BLOCK)).withColumn("_to", F.least("_to", (F.col("_b") + 1) * UNIT_BLOCK))
    buys = t.filter(F.col("_side") == buy).drop("_side")
    # The sells of a key have all numbers up to their last, so those in a block are its first ones.
    sold = t.filter(F.col("_side") == sell).groupBy(*keys, "_b").agg(F.max("_to").alias("_sold"))
    filled = F.col("_sold") == (F.col("_b") + 1) * UNIT_BLOCK
    left = buys.join(sold, [*keys, "_b"], "left").filter(F.col("_sold").isNull() | ~filled)
    runs = F.when(F.col("_sold").isNull(), F.array(F.struct(F.lit(None).cast("long").alias("_idx"), (F.col("_to") - F.col("_from")).alias("_n"))))
    units = F.transform(F.sequence("_from", F.col("_to") - 1), lambda n: F.struct(n.alias("_idx"), F.lit(1).cast("long").alias("_n")))
    left = left.select(*keys, "_px", F.explode(runs.otherwise(units)).alias("_u")).select(*keys, "_px", "_u.*")
    gone = sold.filter(~filled).select(*keys, F.explode(F.sequence(F.col("_b") * UNIT_BLOCK, F.col("_sold") - 1)).alias("_idx"))
    unmatched = left.join(gone, [*keys, "_idx"], "left_anti")
    return _summarise(unmatched, keys, "_n", "_px", as_of, partition_col)


def _block_of(number: Column) -> Column:
    return F.shiftright(number, UNIT_BLOCK.bit_length() - 1)
