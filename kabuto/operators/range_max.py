"""Highest value and its earliest date over any period, from few rows.

A table of block maxima: level k holds, for every key and every month that one starts at, the best row of the
2**k months from there on. Each level is the one below combined with itself half a block later, so the
table takes about log2(months) rows a key and month, and a later run only has to add months. Any run of whole
months is the better of two blocks (they may overlap: a maximum doesn't mind), and a period is that run
and the days of the two months that it cuts. Periods, blocks and days meet by equality of key and month,
so a key with a third of all rows is spread over its months.

Of equal values the earliest date is kept; a period with NULL values only has its earliest date and no
value; one without rows has neither. NaN counts as the largest value, as in the aggregates of Spark.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "_m"
LEVELS_A_STEP = 4  # of block maxima


def _month_number(d) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    return F.year(d) * 12 + F.month(d) - 1


def _best(value: str, date: str) -> Column:
    """Comparable: a larger value first, a NULL last, then the earlier date."""
    return F.struct(F.col(value).alias("v"), (-F.unix_date(date)).alias("d"))


def block_maxima(values: DataFrame, key: str = "ticker", date: str = "base_date", value: str = "price", months: int = 480) -> DataFrame:
    """(key, _level, _m, _best): the best row of the 2**_level months from month number _m, for blocks
    of up to ``months`` months. Rows without a date are in no period.

    ``LEVELS_A_STEP`` levels are made at a time from the highest one before them (a block of 2**k months is
    the best of the blocks of that level in it), so that the plan holds few aggregates, whatever ``months``."""
    level = values.filter(F.col(date).isNotNull()).groupBy(key, _month_number(date).alias(MONTH)).agg(F.max(_best(value, date)).alias("_best"))
    out = level.withColumn("_level", F.lit(0))
    top = max(1, math.floor(math.log2(max(1, months))))
    for low in range(0, top, LEVELS_A_STEP):
        high = min(top, low + LEVELS_A_STEP)
        held_by = [F.struct(F.lit(k).alias("_level"), (F.col(MONTH) - (n << low)).alias(MONTH)) for k in range(low + 1, high + 1) for n in range(1 << k - low)]
        step = level.select(key, F.explode(F.array(*held_by)).alias("_block"), "_best").select(key, "_block.*", "_best").groupBy(key, "_level", MONTH).agg(F.max("_best").alias("_best"))
        out = out.unionByName(step)
        level = step.filter(F.col("_level") == high).drop("_level")
    return out.select(key, "_level", MONTH, "_best")


def range_highs(
    periods: DataFrame, values: DataFrame, blocks: DataFrame, key: str = "ticker", start: str = "start", end: str = "end", date: str = "base_date", value: str = "price", out: str = "max_price", out_date: str = "max_price_date"
) -> DataFrame:
    """``periods`` (key, start, end, other columns; both ends included) with the highest value of its key in the
    period and the earliest date of it. ``blocks`` are ``block_maxima`` of ``values``, long enough for
    the longest period. Periods without an end, or that end before they start, hold nothing."""
    asked = periods.select(F.col(key).alias("_k"), F.col(start).alias("_a"), F.col(end).alias("_b")).filter("_a <= _b AND _k IS NOT NULL").distinct()
    first, last = _month_number("_a"), _month_number("_b")
    # Whole months between the two that are cut (which are whole, too, if the period begins or ends with them).
    lo = F.when(F.dayofmonth("_a") == 1, first).otherwise(first + 1)
    hi = F.when(F.col("_b") == F.last_day("_b"), last).otherwise(last - 1)
    asked = asked.withColumns({"_lo": lo, "_hi": hi})
    whole = asked.filter("_lo <= _hi").withColumn("_level", F.length(F.bin(F.col("_hi") - F.col("_lo") + 1)) - 1)
    whole = whole.withColumn(MONTH, F.explode(F.array("_lo", F.expr("_hi + 1 - shiftleft(1, _level)"))))
    of_blocks = whole.join(blocks.withColumnRenamed(key, "_k"), ["_k", "_level", MONTH]).select("_k", "_a", "_b", "_best")
    cut = F.array_distinct(F.filter(F.array(F.when(F.col("_lo") > first, first), F.when(F.col("_hi") < last, last)), lambda m: m.isNotNull()))
    days = values.select(F.col(key).alias("_k"), F.col(date).alias("_day"), _month_number(date).alias(MONTH), _best(value, date).alias("_best"))
    of_days = asked.withColumn(MONTH, F.explode(cut)).join(days, ["_k", MONTH]).filter(F.col("_day").between(F.col("_a"), F.col("_b"))).select("_k", "_a", "_b", "_best")
    best = of_blocks.unionByName(of_days).groupBy("_k", "_a", "_b").agg(F.max("_best").alias("_best"))
    joined = periods.join(best, (F.col(key) == F.col("_k")) & (F.col(start) == F.col("_a")) & (F.col(end) == F.col("_b")), "left")
    return joined.select(*periods.columns, F.col("_best.v").alias(out), F.date_from_unix_date(-F.col("_best.d")).alias(out_date))
