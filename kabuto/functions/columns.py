"""Column expressions shared by the models.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kabuto.sources.schemas import _to_date

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    """A date literal from a ``datetime.date``/ISO string, or a Column passed through."""
    if isinstance(d, Column):
        return d
    return F.lit(_to_date(d))


# Day-of-week numbering: 1 = Sunday ... 7 = Saturday (same in Spark's dayofweek).
SUNDAY, SATURDAY = 1, 7


def is_weekend(d: ColumnOrName) -> Column:
    return F.dayofweek(_c(d)).isin(SUNDAY, SATURDAY)


def prev_weekday(d: ColumnOrName) -> Column:
    """Roll a weekend date back to the Friday before; weekdays are unchanged."""
    d = as_date(d) if not isinstance(d, str) else F.col(d)
    dow = F.dayofweek(d)
    return F.when(dow == SUNDAY, F.date_sub(d, 2)).when(dow == SATURDAY, F.date_sub(d, 1)).otherwise(d)


def valuation_date(d, weekend_flag: ColumnOrName) -> Column:
    """``IF(flag, d, prev_weekday(d))``: a NULL flag takes the weekday branch."""
    d = as_date(d) if not isinstance(d, str) else F.col(d)
    return F.when(_c(weekend_flag), d).otherwise(prev_weekday(d))


def add_months_back(d, months: int) -> Column:
    """``d - INTERVAL n MONTH`` with month-end clamping (05-31 minus 3 months = 02-28/29)."""
    d = as_date(d) if not isinstance(d, str) else F.col(d)
    return F.add_months(d, -months)


# Datetime text patterns. Lenient on zero padding (2025/9/5 1:02:03 parses), strict on garbage.
DASH_DATETIME = "yyyy-M-d H:m:s"
SLASH_DATETIME = "yyyy/M/d H:m:s"


def parse_datetime(c: ColumnOrName, pattern: str = DASH_DATETIME) -> Column:
    """Text to ``timestamp_ntz``; malformed text raises (ANSI), like the warehouse parser."""
    return F.to_timestamp_ntz(_c(c), F.lit(pattern))


def try_parse_datetime(c: ColumnOrName) -> Column:
    """``SAFE_CAST(x AS DATETIME)``: NULL when the text is not a datetime."""
    return _c(c).try_cast(T.TimestampNTZType())


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """NULL instead of an error when the divisor is zero (or NULL)."""
    return F.try_divide(_c(a), _c(b))


# Money is summed as two exact DECIMAL parts, what fits six decimals and what is left of it, and
# only the totals are turned back into DOUBLE. Sums then do not depend on the order in which
# partitions are combined, and amounts far below 1e-6 are not lost.
MONEY = T.DecimalType(38, 6)
MONEY_REST = T.DecimalType(38, 24)


def money_parts(c: ColumnOrName) -> tuple[Column, Column]:
    """A DOUBLE amount as (its six-decimal part, the rest), both exact DECIMALs."""
    high = _c(c).cast(MONEY)
    return high, (_c(c) - high.cast(T.DoubleType())).cast(MONEY_REST)


def money_total(high: Column, rest: Column) -> Column:
    """The DOUBLE total of the two summed parts."""
    return high.cast(T.DoubleType()) + rest.cast(T.DoubleType())


# An exact amount is six decimals of up to 1e14 (times units) and what is left of it.
PRICED_REST = T.DecimalType(38, 20)
LARGEST_EXACT = 1e14


def priced_parts(c: ColumnOrName, units: ColumnOrName) -> tuple[Column, Column, Column, Column]:
    """Of a DOUBLE price and a whole number of units (up to 1e17): the exact value of the units in two
    DECIMAL parts, the value in floating point where the price has no exact one (NaN, infinite, or from
    1e14 on: these parts are 0 then), and the units that have a price (NULL for none)."""
    px, n = _c(c).cast(T.DoubleType()), _c(units)
    exact = F.abs(px) < F.lit(LARGEST_EXACT)  # NaN counts as larger than any number
    fine = F.when(exact, px).when(px.isNotNull(), F.lit(0.0))
    high, rest = money_parts(fine)
    times = n.cast(T.DecimalType(17, 0))
    high, rest = high.cast(T.DecimalType(20, 6)) * times, rest.cast(T.DecimalType(20, 20)) * times
    return high, rest, F.when(~exact, px * n), F.when(px.isNotNull() & (n > 0), n)


def priced_value(value: Column, rest: Column, wild: Column) -> Column:
    """The DOUBLE total of summed ``priced_parts``."""
    total = money_total(value, rest)
    return F.when(wild.isNull(), total).otherwise(total + wild)


def priced_total(value: str, rest: str, wild: str, priced: str) -> Column:
    """The mean price, over columns that hold sums of ``priced_parts``."""
    return priced_value(F.sum(value).cast(MONEY), F.sum(rest).cast(PRICED_REST), F.sum(wild)) / F.sum(priced)


def money_sum(c: ColumnOrName, units: ColumnOrName | None = None) -> Column:
    """``SUM(x)`` of a DOUBLE amount, accumulated exactly and returned as DOUBLE (NULL if no rows).

    With ``units`` (whole numbers up to 1e17), each amount counts that many times; the products are exact,
    too, for amounts below 1e14, and summed in floating point for larger ones and NaN."""
    if units is not None:
        high, rest, wild, _ = priced_parts(c, units)
        return priced_value(F.sum(high), F.sum(rest), F.sum(wild))
    high, rest = money_parts(c)
    return money_total(F.sum(high), F.sum(rest))
