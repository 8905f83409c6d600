"""Period extremes: highest value and its date over several trailing periods, in one pass."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kabuto.functions.columns import add_months_back, as_date


def period_highs(
    df: DataFrame,
    as_of: dt.date,
    periods: dict[str, int],
    key: str = "ticker",
    date_col: str = "base_date",
    value: str = "price",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Per ``key``: ``max_<value>_<label>`` and ``max_<value>_date_<label>`` for each trailing
    period of ``months`` months ending at ``as_of`` (inclusive; month-end clamped).

    The date is that of the highest value; ties and an all-NULL period give the earliest date.
    A key with no row in a period gets NULLs for it. One aggregation (partial, map-side) reads
    the longest period once instead of one scan and one join per period. ``extra`` adds further
    aggregate columns to the same pass.
    """
    d = as_date(as_of)
    longest = max(periods.values())
    rows = df.filter(F.col(date_col).between(add_months_back(d, longest), d))
    aggs = []
    for label, months in periods.items():
        inside = F.col(date_col).between(add_months_back(d, months), d)
        rank = F.struct(F.col(value), -F.unix_date(F.col(date_col)))
        aggs.append(F.max(F.when(inside, F.col(value))).alias(f"max_{value}_{label}"))
        aggs.append(F.max_by(F.when(inside, F.col(date_col)), F.when(inside, rank)).alias(f"max_{value}_date_{label}"))
    for name, expr in (extra or {}).items():
        aggs.append(expr.alias(name))
    return rows.groupBy(key).agg(*aggs)
