"""Generic DataFrame -> DataFrame operators (column names are arguments)."""

from kabuto.operators.dedupe import latest_per_key  # noqa: F401
from kabuto.operators.dims import bounded_broadcast, enrich  # noqa: F401
from kabuto.operators.ledger import (  # noqa: F401
    cash_balance,
    cash_from_flows,
    mirror_cash,
    net_from_flows,
    net_units,
    signed_balance,
    totals_from_flows,
    trade_flows,
    trade_totals,
)
from kabuto.operators.lots import open_lots, open_lots_units  # noqa: F401
from kabuto.operators.period import period_highs  # noqa: F401
from kabuto.operators.series import (  # noqa: F401
    bounded_fill,
    calendar_grid,
    close_on_valuation_date,
    cross_rates,
    gap_filled_series,
)
from kabuto.operators.upsert import merge_batch, upsert_partitions  # noqa: F401
