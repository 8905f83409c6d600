"""Descriptions of the published tables and their columns.

Attached to the Spark schema as column metadata (``comment``), which Parquet keeps with the
data, so readers of a published table see what each column means.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TABLE_DESCRIPTIONS = {
    "dwh_price_history": "Daily prices per ticker and price type on the ticker's calendar, gaps filled from the last 14 rows, plus derived cross rates.",
    "dwh_daily_position": "Open long position per account and ticker at the as-of date, matched first-in-first-out.",
    "dm_daily_aum": "Assets under management per account and ticker at the as-of close, cash included.",
    "dm_daily_position_value": "Unrealized gain per open position at the as-of close.",
    "dm_daily_all_term_pl": "Profit and loss over all time per account and ticker, open positions valued at the as-of close.",
    "dm_daily_summary": "Recent close and its change against the previous day, 7 and 28 days before, per listed ticker.",
    "dm_max_price_monitor": "Recent close and the highest close over 3 months, 6 months and 1 year, per listed ticker.",
    "dm_watch_entry_point": "Entry levels and whether the recent close has reached them.",
}

_AGO = {"prev": "a trading day before", "7day": "seven days before", "28day": "28 days before"}
_SPANS = {"3month": "three months", "6month": "six months", "1year": "year"}

COLUMN_DESCRIPTIONS = {
    "account": "Account name",
    "ticker": "Instrument ticker",
    "asset_type": "Asset class of the ticker",
    "asset_name": "Display name of the ticker",
    "base_date": "Business date of the row (partition)",
    "partition_date": "As-of date of the row (partition)",
    "ohlc_type": "Price type: open, high, low or close",
    "price": "Price (filled from earlier rows when missing)",
    "fetch_time_jst": "Time the price was fetched (local time, no zone)",
    "position": "Quantity held; for cash the cash balance",
    "avg_buy_price": "Average buy price of the units still held",
    "value_price": "Price used for valuation; 1 for cash",
    "current_value": "Market value: quantity times price; for cash the balance",
    "close_price": "Close on the valuation date",
    "unrealized_value": "(close - average buy price) x quantity",
    "unrealized_return_ratio": "(close - average buy price) / average buy price",
    "total_buy_amount": "Sum of price x quantity of all buys",
    "sell_amount_already": "Sum of price x quantity of all sells",
    "position_close_amount": "Value of the open position at the close",
    "total_sell_amount": "Realised sells plus the value of the open position",
    "pl_amount_all_term": "Total sell amount minus total buy amount",
    "pl_ratio_all_term": "Total sell amount / total buy amount - 1",
    "recent_price_date": "Date of the recent close",
    "recent_price": "Recent close",
    "is_reached_entry_price": "Entry level at or above the recent close",
    "entry_price": "Entry level",
    "add_date": "Date the entry level was added",
    "memo": "Free text",
    "order_group": "Group of the row in reports",
    "order_index": "Place of the row in its group",
    "is_active_weekend": "Whether the ticker trades on weekends",
    "recent_date": "Date of the recent close: the as-of date, or the weekday before a weekend",
    "prev_date": "The trading day before the recent one",
    "date_7day_ago": "Seven days before, on the ticker's calendar",
    "date_28day_ago": "28 days before, on the ticker's calendar",
    "price_recent_date": "Close on the recent date",
    "price_prev_date": "Close on the trading day before",
    "price_7day_ago": "Close seven days before",
    "price_28day_ago": "Close 28 days before",
    **{f"diff_recent_{x}": f"Recent close minus the one {text}" for x, text in _AGO.items()},
    **{f"rate_recent_{x}": f"Change of the recent close against the one {text}" for x, text in _AGO.items()},
    **{f"max_price_{x}": f"Highest close in the last {text}" for x, text in _SPANS.items()},
    **{f"max_price_date_{x}": f"Earliest date of the highest close in the last {text}" for x, text in _SPANS.items()},
}


def describe(df: DataFrame) -> DataFrame:
    """Attach the known column descriptions as ``comment`` metadata."""
    out = df
    for c in df.columns:
        text = COLUMN_DESCRIPTIONS.get(c)
        if text:
            out = out.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    return out


def register_tables(spark: SparkSession, paths: dict[str, str], database: str = "default") -> None:
    """Create (or replace) a table in the session catalog for each published table (name: path), with the
    descriptions of the table and its columns as comments, read back by DESCRIBE."""
    for name, path in paths.items():
        schema = spark.read.parquet(path).schema
        quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT {quote(COLUMN_DESCRIPTIONS.get(f.name, ''))}" for f in schema.fields)
        part = [c for c in ("base_date", "partition_date") if c in schema.names][:1]
        spark.sql(f"DROP TABLE IF EXISTS {database}.`{name}`")
        spark.sql(
            f"CREATE TABLE {database}.`{name}` ({columns}) USING parquet PARTITIONED BY ({', '.join(part)}) "
            f"LOCATION {quote(path)} COMMENT {quote(TABLE_DESCRIPTIONS.get(name, ''))}"
        )
        spark.catalog.recoverPartitions(f"{database}.{name}")


def described(spark: SparkSession, names: Iterable[str], database: str = "default") -> DataFrame:
    """What the catalog says: (table_name, table_comment, column_name, column_type, column_comment)."""
    rows = []
    for name in names:
        table = spark.catalog.getTable(f"{database}.{name}")
        rows += [(name, table.description, c.name, c.dataType, c.description) for c in spark.catalog.listColumns(f"{database}.{name}")]
    return spark.createDataFrame(rows, "table_name string, table_comment string, column_name string, column_type string, column_comment string")
