"""The trade log kept as sums, so that a run reads what has arrived and not the log.

Two tables under a root, both of ``trade_flows`` columns (exact sums, which add up in any order):

  ledger_days    one row per (keys, day), partitioned by month
  ledger_months  one row per (keys, month), partitioned by month

Together they are, for every key, a queue of buys in FIFO order with one run a day (its units and their
exact value) behind a head that the units sold so far move on. ``update_ledger`` recomputes the days on
which trades have arrived, late ones included, from these days of the log, and the months that hold
them; nothing else is read or written, and doing it twice changes nothing. ``flows_at`` gives the sums
up to a date from the months before it and the days of its own month. ``open_lots_at`` moves every head: from
the months to the one that it falls into, from this month's days to the day, and only then reads lots,
those of the days that some key's head falls into. A late buy before the head, or a late sell, moves the head by
sums alone; what it reopens is still there as runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kabuto.functions.columns import as_date
from kabuto.operators.ledger import trade_flows
from kabuto.operators.lots import LOT_VALUE, PIECES, boundary, buy_lots, cut_lots, fifo_splitters, lot_flows, near_cut, summed_lots
from kabuto.operators.upsert import existing_table, upsert_partitions
from kabuto.session import Scratch, ensure_checkpoint_dir

KEYS = ("account", "ticker")
DAYS, MONTHS = "ledger_days", "ledger_months"
_GROUPS = ("trade_date", "month")


def _month(c) -> F.Column:
    return F.trunc(c, "month")


def _summed(flows: DataFrame, keys: Sequence[str], group: str) -> DataFrame:
    values = [c for c in flows.columns if c not in (*keys, *_GROUPS)]
    types = {c: flows.schema[c].dataType for c in values}
    return flows.groupBy(*keys, group).agg(*[F.sum(c).cast(types[c]).alias(c) for c in values])


def update_ledger(spark: SparkSession, trades: DataFrame, arrived: DataFrame, root: str, keys: Sequence[str] = KEYS, date_col: str = "trade_date") -> list[dt.date]:
    """Bring the tables under ``root`` up to date with ``trades`` (the log, all of it), of which the
    rows in ``arrived`` are new: only their dates matter. Trades without a date belong to no position and
    are left out. Returns the months that were rewritten.

    The list of months comes to the driver (as many as months have new trades); dates stay a table."""
    with Scratch(spark) as scratch:  # written, so that what has arrived is read once
        dates = arrived.select(F.col(date_col).alias("trade_date")).filter("trade_date IS NOT NULL").distinct()
        return _update(spark, trades, scratch.write(dates, "dates"), root, keys, date_col)


def _update(spark: SparkSession, trades: DataFrame, dates: DataFrame, root: str, keys: Sequence[str], date_col: str) -> list[dt.date]:
    months = sorted(r[0] for r in dates.select(_month("trade_date")).distinct().collect())
    if not months:
        return []
    last = F.last_day(F.lit(months[-1]))
    log = trades.filter(F.col(date_col).between(F.lit(months[0]), last) & _month(F.col(date_col)).isin(months))
    log = log.join(F.broadcast(dates.withColumnRenamed("trade_date", "_new")), F.col(date_col) == F.col("_new"), "left_semi")
    new = trade_flows(log, last, keys, date_col).withColumnRenamed(date_col, "trade_date").withColumn("month", _month(F.col("trade_date")))
    path = f"{root.rstrip('/')}/{DAYS}"
    old = existing_table(spark, path, new.schema)
    if old is not None:  # the other days of these months
        rest = old.filter(F.col("month").isin(months)).join(F.broadcast(dates), "trade_date", "left_anti")
        new = rest.select(*new.columns).unionByName(new)
    day_keys = [*keys, "trade_date", "month"]
    upsert_partitions(spark, new, path, day_keys, "month", replace_partition=True, partitions=months, check_unique=False)
    days = spark.read.schema(new.schema).parquet(path).filter(F.col("month").isin(months))
    upsert_partitions(spark, _summed(days, keys, "month"), f"{root.rstrip('/')}/{MONTHS}", [*keys, "month"], "month", replace_partition=True, partitions=months, check_unique=False)
    return months


def _periods(spark: SparkSession, root: str, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """The months before that of ``as_of``, and the days of its month up to it; the date is ``_d``."""
    root = root.rstrip("/")
    months, days = existing_table(spark, f"{root}/{MONTHS}"), existing_table(spark, f"{root}/{DAYS}")
    if months is None or days is None:
        raise ValueError(f"no ledger under {root}; update_ledger writes it")
    first = _month(as_date(as_of))
    months = months.filter(F.col("month") < first).withColumnRenamed("month", "_d")
    return months, days.filter((F.col("month") == first) & (F.col("trade_date") <= as_date(as_of))).drop("month").withColumnRenamed("trade_date", "_d")


def flows_at(spark: SparkSession, root: str, as_of: dt.date, date_col: str = "trade_date") -> DataFrame:
    """The sums of all trades up to ``as_of``, for ``totals_from_flows``, ``cash_from_flows`` and
    ``net_from_flows``: a row per key and earlier month (its date the month's first) or day of the last month."""
    months, days = _periods(spark, root, as_of)
    return months.unionByName(days.select(*months.columns)).withColumnRenamed("_d", date_col)


def open_lots_at(
    spark: SparkSession,
    trades: DataFrame,
    root: str,
    as_of: dt.date,
    keys: Sequence[str] = KEYS,
    date_col: str = "trade_date",
    tie_break: Sequence[str] = ("memo", "price", "order_count"),
    instrument: str = "ticker",
    exclude: Sequence[str] = ("cash",),
    partition_col: str = "partition_date",
) -> DataFrame:
    """``lots.open_lots`` from the ledger tables: the log ``trades`` is read on the days of the heads only."""
    keys = list(keys)
    ensure_checkpoint_dir(spark)
    months, days = _periods(spark, root, as_of)
    kept, keyed = F.lit(True), F.lit(True)
    for x in exclude:
        kept = kept & (F.col(instrument) != F.lit(x))
    for k in keys:  # sells never match a NULL key
        keyed = keyed & F.col(k).isNotNull()
    packed = [F.struct(*[F.col(c) for c in keys]).alias("_k"), F.coalesce("_buy_units", F.lit(0)).alias("_dq"), "_d", *LOT_VALUE]

    # The head among the months, and the days of the last one.
    periods = months.select("*", F.lit(True).alias("_whole")).unionByName(days.select(*months.columns, F.lit(False).alias("_whole"))).filter(kept)
    sold = periods.filter(keyed).groupBy(*keys).agg(F.sum("_sell_units").alias("_gone"))
    sold = sold.select(F.struct(*[F.col(c) for c in keys]).alias("_k"), F.coalesce("_gone", F.lit(0)).alias("_gone"))
    groups = periods.select(*packed, "_whole").join(sold, "_k", "left").fillna(0, ["_gone"])
    whole, head = boundary(groups, ["_d", "_whole"])
    head = head.checkpoint()

    # Its day: of a month, found among the month's days.
    in_month = head.filter("_whole").select("_k", F.col("_d").alias("month"), "_gone")
    which = [r[0] for r in in_month.select("month").distinct().collect()]  # months at most
    inside = existing_table(spark, f"{root.rstrip('/')}/{DAYS}").filter(F.col("month").isin(which)).filter(kept).withColumnRenamed("trade_date", "_d")
    inside = inside.select(*packed, "month").join(in_month, ["_k", "month"])
    more, head_day = boundary(inside, ["_d"])
    head_day = head.filter(~F.col("_whole")).select("_k", "_d", "_gone").unionByName(head_day).checkpoint()

    # Its lots: the days of all heads, a large one in pieces.
    dates = [r[0] for r in head_day.select("_d").distinct().collect()]  # days at most
    log = trades.filter(F.col(date_col).isin(dates)).filter(kept)
    cut = fifo_splitters(log, as_of, date_col, tie_break, instrument=instrument, exclude=exclude, pieces=PIECES)
    buys = buy_lots(log, keys, date_col, tie_break, "order_count", "price", "trade_type", "buy", cut)
    pieces = lot_flows(log, keys, date_col, "order_count", "price", "trade_type", "buy", "sell", cut)
    pieces = pieces.select(F.struct(*[F.col(c) for c in keys]).alias("_k"), F.col(date_col).alias("_d"), "_piece", F.coalesce("_buy_units", F.lit(0)).alias("_dq"), *LOT_VALUE)
    rest, head_piece = boundary(near_cut(pieces, head_day).join(head_day, ["_k", "_d"]), ["_d", "_piece"])
    lots = whole.unionByName(more).unionByName(rest).unionByName(cut_lots(buys, head_piece, len(tie_break)))
    return summed_lots(lots, keys, as_of, partition_col)
