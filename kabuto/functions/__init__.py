"""Column-level functions (JVM expressions only; no Python UDF)."""

from kabuto.functions.columns import (  # noqa: F401
    add_months_back,
    is_weekend,
    money_sum,
    parse_datetime,
    prev_weekday,
    safe_divide,
    try_parse_datetime,
    valuation_date,
)
