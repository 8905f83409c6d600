"""Dense daily series: calendar grid, bounded forward fill, derived cross rates, dated lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kabuto.functions.columns import as_date, is_weekend, valuation_date
from kabuto.operators.dims import bounded_broadcast


def calendar_grid(
    keys: DataFrame,
    start: dt.date,
    end: dt.date,
    weekend_flag: str = "is_active_weekend",
    date_col: str = "base_date",
) -> DataFrame:
    """``keys`` x every date in [start, end] on each key's own calendar.

    flag TRUE: every day; FALSE: Monday to Friday; NULL: no dates at all (the key is dropped).
    Generated with ``explode(sequence)`` per key row, so no cross join and no shuffle.
    """
    if start > end:
        return keys.limit(0).withColumn(date_col, F.lit(None).cast("date"))
    days = F.explode(F.sequence(as_date(start), as_date(end), F.expr("INTERVAL 1 DAY")))
    flag = F.col(weekend_flag)
    grid = keys.filter(flag.isNotNull()).withColumn(date_col, days)
    return grid.filter(_on_calendar(F.col(date_col), flag))


def bounded_fill(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str,
    columns: Sequence[str],
    max_rows: int,
) -> DataFrame:
    """Replace each of ``columns`` by its last non-NULL value within the current row and the
    ``max_rows`` rows before it (rows, not days). Columns are filled independently."""
    w = Window.partitionBy(*partition_by).orderBy(order_by).rowsBetween(-max_rows, Window.currentRow)
    filled = set(columns)
    return df.select(*[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in filled else F.col(c) for c in df.columns])


def _on_calendar(d: Column, flag: Column) -> Column:
    # TRUE: every day; FALSE: weekdays; NULL: never (NULL OR (NULL AND x) is not TRUE).
    return (flag == F.lit(True)) | ((flag == F.lit(False)) & ~is_weekend(d))


def gap_filled_series(
    values: DataFrame,
    flags: DataFrame,
    keys: Sequence[str],
    value_cols: Sequence[str],
    start: dt.date,
    end: dt.date,
    max_rows: int,
    date_col: str = "base_date",
    flag_key: str = "ticker",
    weekend_flag: str = "is_active_weekend",
) -> DataFrame:
    """Put sparse ``values`` (unique per keys + date) on each key's calendar and forward-fill.

    Keys are those present in ``values``; their calendar comes from ``flags`` (joined on
    ``flag_key``; an unknown key has no calendar). Value rows off the calendar are dropped.

    Physical shape: ``values`` is hash-partitioned once by ``keys``. Within that partitioning,
    the first row of each series also emits the series' calendar (``explode``), grid and value
    rows are merged by an aggregate per (keys, date), and the fill window runs; none of these
    steps shuffles again, and the source is read once.
    """
    keys = list(keys)
    if start > end:
        return values.limit(0).select(date_col, *keys, *value_cols)
    vals = values.select(date_col, *keys, *value_cols).repartition(*keys)
    vals = vals.join(bounded_broadcast(flags).select(flag_key, weekend_flag), flag_key, "left")
    flag = F.col(weekend_flag)
    vals = vals.withColumn("_first", F.row_number().over(Window.partitionBy(*keys).orderBy(date_col)) == 1)
    nulls = [F.lit(None).cast(values.schema[c].dataType).alias(c) for c in value_cols]
    # An equality join never matches NULL keys: such a series keeps its calendar, values NULL.
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    own_vals = [F.when(keyed, F.col(c)).alias(c) for c in value_cols]
    own = F.array(F.struct(F.col(date_col).alias("_d"), F.lit(False).alias("_g"), *own_vals))
    days = F.filter(F.sequence(as_date(start), as_date(end), F.expr("INTERVAL 1 DAY")), lambda d: _on_calendar(d, flag))
    calendar = F.transform(days, lambda d: F.struct(d.alias("_d"), F.lit(True).alias("_g"), *nulls))
    rows = vals.select(*keys, F.explode(F.when(F.col("_first"), F.concat(own, calendar)).otherwise(own)).alias("_r")).select(*keys, "_r.*")
    dense = (
        rows.groupBy(*keys, "_d")
        .agg(F.max("_g").alias("_g"), F.max_by(F.struct(*value_cols), ~F.col("_g")).alias("_v"))
        .filter(F.col("_g"))
        .select(F.col("_d").alias(date_col), *keys, *[F.col(f"_v.{c}").alias(c) for c in value_cols])
    )
    return bounded_fill(dense, keys, date_col, value_cols, max_rows)


def cross_rates(
    filled: DataFrame,
    pairs: Sequence[tuple[str, str, str]],
    max_rows: int,
    close: str = "close",
    date_col: str = "base_date",
    ticker: str = "ticker",
    ohlc: str = "ohlc_type",
    price: str = "price",
    fetch_time: str = "fetch_time_jst",
) -> DataFrame:
    """Derived close series ``out = base x quote`` for each (base, quote, out) pair.

    Rows follow the base leg's calendar; the quote is its last known value within the current
    and ``max_rows`` preceding base rows (NULL if none). Fetch time is the base leg's.
    Each pair is one window partition (never a global single-task window).
    """
    spec = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(q).alias("q"), F.lit(o).alias("o")) for b, q, o in pairs])
    legs = sorted({b for b, _, _ in pairs} | {q for _, q, _ in pairs})
    # Every leg row goes to each pair it feeds (as base and/or quote); one shuffle by output pair.
    routed = (
        filled.filter((F.col(ohlc) == close) & F.col(ticker).isin(legs))
        .withColumn("_pair", F.explode(F.filter(spec, lambda s: (s["b"] == F.col(ticker)) | (s["q"] == F.col(ticker)))))
        .select(
            F.col("_pair.o").alias("_out"),
            F.col(date_col),
            F.when(F.col("_pair.b") == F.col(ticker), F.struct(F.col(price).alias("p"), F.col(fetch_time).alias("t"))).alias("_b"),
            F.when(F.col("_pair.q") == F.col(ticker), F.col(price)).alias("_quote"),
            (F.col("_pair.b") == F.col(ticker)).alias("_is_base"),
        )
        .repartition("_out")
    )
    # Align legs by date (rows follow the base calendar; a missing quote row gives NULL).
    aligned = (
        routed.groupBy("_out", date_col)
        .agg(F.max("_is_base").alias("_is_base"), F.max("_b").alias("_b"), F.max("_quote").alias("_quote"))
        .filter(F.col("_is_base"))
    )
    w = Window.partitionBy("_out").orderBy(date_col).rowsBetween(-max_rows, Window.currentRow)
    return aligned.select(
        F.col(date_col),
        F.col("_out").alias(ticker),
        F.lit(close).alias(ohlc),
        (F.col("_b.p") * F.last("_quote", ignorenulls=True).over(w)).alias(price),
        F.col("_b.t").alias(fetch_time),
    )


def close_on_valuation_date(
    close: DataFrame,
    flags: DataFrame,
    as_of: dt.date,
    lookback_days: int,
    out: str = "close_price",
    date_col: str = "base_date",
    ticker: str = "ticker",
    weekend_flag: str = "is_active_weekend",
) -> DataFrame:
    """Close price per ticker on its valuation date for ``as_of``: ``as_of`` itself when the
    ticker trades on weekends, else the weekday on or before it (a NULL/unknown flag counts as
    weekday-only). Only prices within ``lookback_days`` before ``as_of`` are considered."""
    d = as_date(as_of)
    recent = close.filter(F.col(date_col).between(F.date_sub(d, lookback_days), d)).select(ticker, date_col, "price")
    recent = recent.join(bounded_broadcast(flags).select(ticker, weekend_flag), ticker, "left")
    return recent.filter(F.col(date_col) == valuation_date(d, weekend_flag)).select(ticker, F.col("price").alias(out))
