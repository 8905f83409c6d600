"""The column checks that the tables are declared with: one table of checks for the daily run, the
check command and the registered query."""

from __future__ import annotations

from kabuto.operators.checks import Check, accepted_values, expression_is_true, not_null, unique
from kabuto.sources.schemas import ASSET_TYPES

#: Columns that are never NULL, by table.
REQUIRED = {
    "ref_ticker_info": "ticker asset_type asset_name is_active_weekend",
    "dim_summary_ticker_list": "ticker order_group order_index",
    "stg_asset_status_history": "event_time_jst ticker is_monitor is_watch",
    "stg_trade_history": "event_time_jst trade_date ticker trade_type account order_count price",
    "stg_price_data": "base_date ticker ohlc_type fetch_time_jst",
    "stg_entry_point": "ticker entry_price",
    "dwh_trade_history_with_cash": "event_time_jst trade_date ticker trade_type account order_count price",
    "dwh_asset_master": "ticker asset_name asset_type is_monitor is_watch latest_status_chg_time_jst",
    "dwh_price_history": "base_date ticker ohlc_type price fetch_time_jst",
    "dwh_daily_position": "account ticker position avg_buy_price partition_date",
    "dm_daily_aum": "account ticker asset_type asset_name position value_price current_value partition_date",
    "dm_daily_position_value": "account ticker asset_type asset_name position avg_buy_price close_price unrealized_value unrealized_return_ratio partition_date",
    "dm_daily_all_term_pl": "account ticker asset_type asset_name total_buy_amount sell_amount_already position_close_amount total_sell_amount pl_amount_all_term partition_date",
    "dm_daily_summary": "ticker order_group asset_name is_active_weekend base_date recent_date prev_date date_7day_ago date_28day_ago",
    "dm_watch_entry_point": "ticker add_date entry_price recent_price",
}
#: Columns that are never negative.
NOT_NEGATIVE = {
    "dwh_daily_position": "position",
    "dm_daily_aum": "position value_price current_value",
    "dm_daily_position_value": "position avg_buy_price close_price",
    "dm_daily_all_term_pl": "total_buy_amount",
}
UNIQUE = {"ref_ticker_info": "ticker", "dim_summary_ticker_list": "ticker"}


def _checks(table: str) -> list[Check]:
    out = [not_null(c) for c in REQUIRED[table].split()]
    out += [expression_is_true(c, ">= 0") for c in NOT_NEGATIVE.get(table, "").split()]
    out += [unique(c) for c in UNIQUE.get(table, "").split()]
    if table == "ref_ticker_info":
        out.append(accepted_values("asset_type", ASSET_TYPES))
    return out


DECLARED: dict[str, list[Check]] = {table: _checks(table) for table in REQUIRED}
