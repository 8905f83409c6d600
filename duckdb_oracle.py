"""DuckDB SQL oracle for every registered query.

Written from the definitions of the results, by other methods than the Spark code and than a model's own
SQL: numbered calendar days and ASOF joins for filled series, one list of (ticker, role, date) for
dated lookups, ranked candidates for period highs, cumulative quantities for lots, lists of signed movements
with one GROUP BY for balances. It works over the same projections of the driver's tables as
``kabuto/sources/fixtures.py``. Money sums are exact: each amount is split into a DECIMAL(38,6) part and a
DECIMAL(38,24) rest.
"""

from __future__ import annotations

import datetime as dt

from kabuto.sources import fixtures as X
from kabuto.sources.descriptions import COLUMN_DESCRIPTIONS, TABLE_DESCRIPTIONS
from kabuto.sources.schemas import RunDates
from kabuto.plans.catalog import PRICE_DATES_PREVIOUS, REPORT_FROM, STREAM_SPLIT


# Date with dashes, then optionally a time, with optional seconds and fraction.
DATETIME_TEXT = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,6})?)?)?"


def D(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def TK(e: str) -> str:
    return f"(CASE {e} WHEN 0 THEN 'BTC-USD' WHEN 1 THEN 'ETH-USD' WHEN 2 THEN 'JPY=X' ELSE concat('U', CAST({e} AS VARCHAR)) END)"


def PW(x: str) -> str:
    """Weekend date -> the Friday before: one day back from a Saturday (6), two from a Sunday (7)."""
    return f"({x} - CAST(greatest(isodow({x}) - 5, 0) AS INTEGER))"


def MSUM(x: str, where: str = "TRUE") -> str:
    high = f"CAST({x} AS DECIMAL(38,6))"
    rest = f"CAST({x} - CAST({high} AS DOUBLE) AS DECIMAL(38,24))"
    return f"(CAST(SUM({high}) FILTER ({where}) AS DOUBLE) + CAST(SUM({rest}) FILTER ({where}) AS DOUBLE))"


def months_back(d: dt.date, n: int) -> str:
    return f"CAST({D(d)} - INTERVAL {n} MONTH AS DATE)"


BASE_CTES = f"""
raw_price_rows AS (
  SELECT CAST(ts AS DATE) AS date, {TK('user_id')} AS ticker,
    CASE event_type WHEN 'view' THEN 'open' WHEN 'click' THEN 'high' WHEN 'signup' THEN 'low' ELSE 'close' END AS ohlc_type,
    CASE WHEN value < 5 THEN NULL ELSE value END AS price,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS fetch_time_str, event_type
  FROM events
),
raw_price_data AS (
  SELECT date, ticker, ohlc_type, price, fetch_time_str FROM raw_price_rows
  UNION ALL
  SELECT date, ticker, ohlc_type, price, fetch_time_str FROM raw_price_rows WHERE event_type = 'purchase'
),
raw_trade_history AS (
  SELECT strftime(l_shipdate, '%Y/%m/%d %H:%M:%S') AS timestamp_jst, CAST(l_shipdate AS DATE) AS trade_date,
    {TK('l_partkey % 20')} AS ticker, CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS trade_type,
    concat('A', CAST(o_custkey % 8 AS VARCHAR)) AS account, CAST(l_quantity AS BIGINT) AS order_count,
    l_extendedprice AS price, CAST(l_orderkey AS VARCHAR) AS memo
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL
  SELECT strftime(o_orderdate, '%Y/%m/%d %H:%M:%S'), CAST(o_orderdate AS DATE), 'cash',
    CASE WHEN o_orderkey % 5 = 0 THEN 'sell' ELSE 'buy' END, concat('A', CAST(o_custkey % 8 AS VARCHAR)),
    CAST(1 AS BIGINT), o_totalprice, CAST(o_orderkey AS VARCHAR)
  FROM orders
),
raw_asset_status_history AS (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time_jst_str, {TK('user_id')} AS ticker,
    value > 100 AS is_monitor, event_type = 'purchase' AS is_watch
  FROM events
),
raw_entry_point AS (
  SELECT CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE DATE '2024-01-02' END AS add_date, {TK('p_partkey % 40')} AS ticker,
    CAST(p_size AS DOUBLE) * CAST(8.0 AS DOUBLE) AS entry_price, p_name AS memo
  FROM part
),
ref_ticker_info AS (
  SELECT {TK('c_custkey')} AS ticker, c_mktsegment AS asset_type, c_name AS asset_name,
    CASE WHEN c_custkey < 2 THEN TRUE WHEN c_custkey % 17 = 16 THEN NULL ELSE c_custkey % 3 = 0 END AS is_active_weekend
  FROM customer
),
dim_summary_ticker_list AS (SELECT {TK('c_custkey')} AS ticker, c_custkey % 5 AS order_group, c_custkey AS order_index FROM customer),
dim_max_price AS (SELECT {TK('c_custkey')} AS ticker, c_custkey % 4 AS order_group, c_custkey AS order_index FROM customer),
long_close AS (
  SELECT CAST(o_orderdate AS DATE) AS base_date, {TK('o_custkey % 10')} AS ticker, 'close' AS ohlc_type, max(o_totalprice) AS price
  FROM orders GROUP BY 1, 2
),
stg_price_data AS (
  SELECT DISTINCT date AS base_date, ticker, ohlc_type, price, strptime(fetch_time_str, '%Y-%m-%d %H:%M:%S') AS fetch_time_jst
  FROM raw_price_data WHERE date IS NOT NULL
),
stg_trade_history AS (
  SELECT strptime(timestamp_jst, '%Y/%m/%d %H:%M:%S') AS event_time_jst, trade_date, ticker, trade_type, account, order_count, price, memo
  FROM raw_trade_history WHERE timestamp_jst IS NOT NULL
),
stg_asset_status_history AS (
  SELECT strptime(event_time_jst_str, '%Y-%m-%d %H:%M:%S') AS event_time_jst, ticker, is_monitor, is_watch
  FROM raw_asset_status_history WHERE event_time_jst_str IS NOT NULL
),
stg_entry_point AS (SELECT add_date, ticker, entry_price, memo FROM raw_entry_point WHERE add_date IS NOT NULL),
latest_prices AS (
  SELECT DISTINCT ON (base_date, ticker, ohlc_type) * FROM stg_price_data
  ORDER BY base_date, ticker, ohlc_type, fetch_time_jst DESC NULLS LAST, price DESC NULLS LAST
),
asset_master AS (
  SELECT ticker, asset_name, asset_type, newest.is_monitor, newest.is_watch, newest.event_time_jst AS latest_status_chg_time_jst
  FROM (SELECT ticker, max({{'event_time_jst': event_time_jst, 'is_monitor': is_monitor, 'is_watch': is_watch}}) AS newest
        FROM stg_asset_status_history GROUP BY ticker) LEFT JOIN ref_ticker_info USING (ticker)
),
trades_with_cash AS (
  SELECT event_time_jst, trade_date, CASE WHEN leg = 'own' THEN ticker ELSE 'cash' END AS ticker,
    CASE WHEN leg = 'own' THEN trade_type WHEN trade_type = 'buy' THEN 'sell' ELSE 'buy' END AS trade_type, account,
    CASE WHEN leg = 'own' THEN CAST(order_count AS DOUBLE) ELSE price * order_count END AS order_count,
    CASE WHEN leg = 'own' THEN price ELSE CAST(1 AS DOUBLE) END AS price, memo
  FROM stg_trade_history, unnest(['own', 'mirror']) AS legs(leg)
  WHERE leg = 'own' OR ticker <> 'cash'
)"""


FILL = 14  # rows that a value is carried on


def price_history_ctes(s: str, r: RunDates | tuple[str, str, str]) -> str:
    """Dense price history, each value carried on for up to ``FILL`` rows, with cross rates, for run dates
    ``r`` (suffix ``s``); ``r`` may also be SQL date expressions (history_from, update_from, as_of).

    A series' days are numbered on its own calendar (every day, or weekdays); a day takes the last
    value at or before it, if that is at most ``FILL`` numbers back."""
    h, u, a = r if isinstance(r, tuple) else (D(r.history_from), D(r.update_from), D(r.as_of))
    return f""",
ph_seen_{s} AS (
  SELECT l.*, is_active_weekend AS daily FROM latest_prices l JOIN ref_ticker_info USING (ticker)
  WHERE base_date BETWEEN {h} AND {a} AND is_active_weekend IS NOT NULL
),
ph_day_{s} AS (
  SELECT ticker, ohlc_type, base_date, row_number() OVER (PARTITION BY ticker, ohlc_type ORDER BY base_date) AS n
  FROM (
    SELECT ticker, ohlc_type, daily, CAST(unnest(generate_series(CAST({h} AS TIMESTAMP), CAST({a} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS base_date
    FROM (SELECT DISTINCT ticker, ohlc_type, daily FROM ph_seen_{s})
  ) WHERE daily OR isodow(base_date) < 6
),
ph_value_{s} AS (SELECT ticker, ohlc_type, base_date, n, price, fetch_time_jst FROM ph_seen_{s} JOIN ph_day_{s} USING (ticker, ohlc_type, base_date)),
ph_filled_{s} AS (
  SELECT d.base_date, d.ticker, d.ohlc_type, d.n,
    CASE WHEN d.n - p.n <= {FILL} THEN p.price END AS price, CASE WHEN d.n - f.n <= {FILL} THEN f.fetch_time_jst END AS fetch_time_jst
  FROM ph_day_{s} d
  ASOF LEFT JOIN (FROM ph_value_{s} WHERE price IS NOT NULL) p ON d.ticker = p.ticker AND d.ohlc_type = p.ohlc_type AND d.base_date >= p.base_date
  ASOF LEFT JOIN (FROM ph_value_{s} WHERE fetch_time_jst IS NOT NULL) f ON d.ticker = f.ticker AND d.ohlc_type = f.ohlc_type AND d.base_date >= f.base_date
),
ph_leg_{s} AS (
  SELECT name, f.* FROM ph_filled_{s} f, (VALUES {PAIRS}) AS pairs(leg, quote, name) WHERE ticker = leg AND ohlc_type = 'close'
),
ph_rate_{s} AS (
  SELECT l.name, l.base_date, l.n, q.price AS rate FROM ph_leg_{s} l, ph_filled_{s} q, (VALUES {PAIRS}) AS pairs(leg, quote, name)
  WHERE l.name = pairs.name AND q.ticker = quote AND q.ohlc_type = 'close' AND q.base_date = l.base_date AND q.price IS NOT NULL
),
ph_cross_{s} AS (
  SELECT l.base_date, l.name AS ticker, 'close' AS ohlc_type, CASE WHEN l.n - q.n <= {FILL} THEN l.price * q.rate END AS price, l.fetch_time_jst
  FROM ph_leg_{s} l ASOF LEFT JOIN ph_rate_{s} q ON l.name = q.name AND l.base_date >= q.base_date
),
price_history_{s} AS (
  SELECT * EXCLUDE (n) FROM ph_filled_{s} WHERE base_date BETWEEN {u} AND {a}
  UNION ALL BY NAME
  SELECT * FROM ph_cross_{s} WHERE base_date BETWEEN {u} AND {a}
),
close_{s} AS (SELECT * FROM price_history_{s} WHERE ohlc_type = 'close')"""


PAIRS = "('BTC-USD', 'JPY=X', 'BTC-JPY'), ('ETH-USD', 'JPY=X', 'ETH-JPY')"


def positions_ctes(s: str, as_of: dt.date) -> str:
    """FIFO open position by cumulative quantities: of a buy, what its running total exceeds all that
    was sold by, up to its size."""
    a = D(as_of)
    return f""",
pos_lot_{s} AS (
  SELECT account, ticker, price, order_count AS q, trade_type,
    sum(order_count) OVER (PARTITION BY account, ticker, trade_type ORDER BY trade_date, event_time_jst, memo, price, order_count ROWS UNBOUNDED PRECEDING) AS so_far
  FROM stg_trade_history WHERE trade_date <= {a} AND ticker != 'cash' AND order_count >= 1
),
pos_open_{s} AS (
  SELECT account, ticker, price, least(q, so_far - coalesce(sold, 0)) AS held
  FROM (FROM pos_lot_{s} WHERE trade_type = 'buy')
    LEFT JOIN (SELECT account, ticker, sum(q) AS sold FROM pos_lot_{s} WHERE trade_type = 'sell' GROUP BY ALL) USING (account, ticker)
),
positions_{s} AS (
  SELECT account, ticker, CAST(sum(held) AS BIGINT) AS position,
    (CAST(sum(CAST(price AS DECIMAL(20,6)) * CAST(held AS DECIMAL(17,0))) AS DOUBLE)
      + CAST(sum(CAST(price - CAST(CAST(price AS DECIMAL(20,6)) AS DOUBLE) AS DECIMAL(20,20)) * CAST(held AS DECIMAL(17,0))) AS DOUBLE))
      / sum(held) FILTER (price IS NOT NULL) AS avg_buy_price,
    {a} AS partition_date
  FROM pos_open_{s} WHERE held > 0 GROUP BY account, ticker
)"""


def closing_ctes(s: str, close: str, as_of: dt.date, lookback: int) -> str:
    """The close of each ticker on the day that it is valued on."""
    a = D(as_of)
    return f""",
closing_{s} AS (
  SELECT ticker, price AS close_price FROM {close} LEFT JOIN ref_ticker_info USING (ticker)
  WHERE base_date = CASE WHEN is_active_weekend THEN {a} ELSE {PW(a)} END AND base_date >= {a} - {lookback}
)"""


def valued_ctes(s: str, pos: str, close: str, as_of: dt.date, lookback: int = 6) -> str:
    return closing_ctes(s, close, as_of, lookback) + f""",
valued_{s} AS (
  SELECT account, ticker, asset_type, asset_name, position, avg_buy_price, close_price
  FROM {pos} LEFT JOIN ref_ticker_info USING (ticker) LEFT JOIN closing_{s} USING (ticker)
)"""


PD, BF = X.PRICE_DATES, X.PRICE_BACKFILL
AS_OF = X.POSITION_AS_OF
CUT = X.POSITION_CUTOFF


def _with(*parts: str) -> str:
    return "WITH " + BASE_CTES + "".join(parts)


PH_PD = price_history_ctes("pd", PD)
PH_BF = price_history_ctes("bf", BF)
PH_PREV = price_history_ctes("prev", PRICE_DATES_PREVIOUS)
POS = positions_ctes("asof", AS_OF)
POS_CUT = positions_ctes("cut", CUT)
VALUED = valued_ctes("asof", "positions_asof", "close_bf", AS_OF)


def _summary_select(order: bool) -> str:
    """One list of (row, role, date), looked up once and turned back into a row."""
    a = D(AS_OF)
    roles = [("recent", "recent_date", 0), ("prev", "prev_date", 1), ("7day", "date_7day_ago", 7), ("28day", "date_28day_ago", 28)]
    price = lambda role: f"max(price) FILTER (role = '{role}')"
    named = {"recent": "price_recent_date", "prev": "price_prev_date", "7day": "price_7day_ago", "28day": "price_28day_ago"}
    cols = [f"max(day) FILTER (role = '{role}') AS {name}" for role, name, _ in roles] + [f"{price(role)} AS {name}" for role, name in named.items()]
    for role in ("prev", "7day", "28day"):
        cols += [f"{price('recent')} - {price(role)} AS diff_recent_{role}", f"({price('recent')} - {price(role)}) / nullif({price(role)}, 0) AS rate_recent_{role}"]
    values = ", ".join(f"('{role}', {back})" for role, _, back in roles)
    body = f"""
, ds_day AS (
  SELECT l.*, asset_name, is_active_weekend, role, CASE
      WHEN is_active_weekend THEN {a} - back
      WHEN NOT is_active_weekend AND role = 'prev' THEN {PW(f'({PW(a)} - 1)')}
      WHEN NOT is_active_weekend THEN {PW(f'({a} - back)')} END AS day
  FROM (SELECT *, row_number() OVER () AS line FROM dim_summary_ticker_list) l LEFT JOIN ref_ticker_info USING (ticker),
    (VALUES {values}) AS roles(role, back)
)
SELECT d.ticker, order_group, order_index, asset_name, is_active_weekend, {a} AS base_date, {', '.join(cols)}
FROM ds_day d LEFT JOIN close_bf c ON c.ticker = d.ticker AND c.base_date = day AND c.base_date BETWEEN {a} - 30 AND {a}
GROUP BY line, d.ticker, order_group, order_index, asset_name, is_active_weekend"""
    return body + ("\nORDER BY order_group, order_index" if order else "")


def _period_high() -> str:
    """Each close a candidate in every period that holds it; the first in rank is the high."""
    a = D(X.HIGHS_AS_OF)
    labels = {"3month": 3, "6month": 6, "1year": 12}
    values = ", ".join(f"('{label}', {months_back(X.HIGHS_AS_OF, months)})" for label, months in labels.items())
    picked = ", ".join(f"max(price) FILTER (label = '{x}') AS max_price_{x}, max(base_date) FILTER (label = '{x}') AS max_price_date_{x}" for x in labels)
    return f"""
, hi AS (
  SELECT ticker, {picked} FROM (
    SELECT ticker, label, price, base_date FROM long_close JOIN (VALUES {values}) AS periods(label, since) ON base_date BETWEEN since AND {a}
    QUALIFY row_number() OVER (PARTITION BY ticker, label ORDER BY price DESC NULLS LAST, base_date) = 1
  ) GROUP BY ticker
)
SELECT order_group, order_index, ticker, asset_name, CASE WHEN is_active_weekend THEN {a} ELSE {PW(a)} END AS recent_price_date,
  close_price AS recent_price, hi.* EXCLUDE (ticker), {a} AS base_date
FROM dim_max_price LEFT JOIN ref_ticker_info USING (ticker) LEFT JOIN hi USING (ticker) LEFT JOIN closing_high USING (ticker)"""


def _price_check() -> str:
    """Forward from what was seen: a price stands for its day and, from a Friday, for the weekend too, where
    the day has none of its own."""
    return f"""
, pc_stand AS (
  SELECT base_date + later AS base_date, ticker, ohlc_type, later, price, fetch_time_jst
  FROM latest_prices, unnest(CASE WHEN isodow(base_date) = 5 THEN [0, 1, 2] ELSE [0] END) AS days(later)
),
pc_daily AS (
  SELECT base_date, ticker, ohlc_type, arg_min(price, later) FILTER (price IS NOT NULL) AS price,
    arg_min(fetch_time_jst, later) FILTER (fetch_time_jst IS NOT NULL) AS fetch_time_jst
  FROM pc_stand WHERE base_date BETWEEN DATE '2000-01-01' AND DATE '2050-12-31'
  GROUP BY ALL HAVING count(price) > 0
)
SELECT * FROM pc_daily
UNION ALL
SELECT base_date, name, 'close', CASE WHEN count(*) = 2 THEN round(product(price), 0) END, max(fetch_time_jst)
FROM pc_daily JOIN (VALUES {PAIRS}) AS pairs(leg, quote, name) ON ticker IN (leg, quote) AND ohlc_type = 'close'
GROUP BY base_date, name HAVING name = 'BTC-JPY' OR base_date BETWEEN {D(REPORT_FROM)} AND {D(AS_OF)}
ORDER BY ticker, base_date"""


def _checks(sources: dict[str, str]) -> str:
    """One row per declared check; ``sources`` maps table names to SQL."""
    never_null = {
        "ref_ticker_info": "ticker, asset_type, asset_name, is_active_weekend",
        "dim_summary_ticker_list": "ticker, order_group, order_index",
        "stg_asset_status_history": "event_time_jst, ticker, is_monitor, is_watch",
        "stg_trade_history": "event_time_jst, trade_date, ticker, trade_type, account, order_count, price",
        "stg_price_data": "base_date, ticker, ohlc_type, fetch_time_jst",
        "stg_entry_point": "ticker, entry_price",
        "dwh_trade_history_with_cash": "event_time_jst, trade_date, ticker, trade_type, account, order_count, price",
        "dwh_asset_master": "ticker, asset_name, asset_type, is_monitor, is_watch, latest_status_chg_time_jst",
        "dwh_price_history": "base_date, ticker, ohlc_type, price, fetch_time_jst",
        "dwh_daily_position": "account, ticker, position, avg_buy_price, partition_date",
        "dm_daily_aum": "account, ticker, asset_type, asset_name, position, value_price, current_value, partition_date",
        "dm_daily_position_value": "account, ticker, asset_type, asset_name, position, avg_buy_price, close_price, "
        "unrealized_value, unrealized_return_ratio, partition_date",
        "dm_daily_all_term_pl": "account, ticker, asset_type, asset_name, total_buy_amount, sell_amount_already, "
        "position_close_amount, total_sell_amount, pl_amount_all_term, partition_date",
        "dm_daily_summary": "ticker, order_group, asset_name, is_active_weekend, base_date, recent_date, prev_date, date_7day_ago, date_28day_ago",
        "dm_watch_entry_point": "ticker, add_date, entry_price, recent_price",
    }
    never_negative = {
        "dwh_daily_position": "position",
        "dm_daily_aum": "position, value_price, current_value",
        "dm_daily_position_value": "position, avg_buy_price, close_price",
        "dm_daily_all_term_pl": "total_buy_amount",
    }

    def row(table, kind, col, expr, severity="error", tags=""):
        return (
            f"SELECT '{table}' AS table_name, '{kind}' AS check_name, '{col}' AS column_name, '{severity}' AS severity, "
            f"'{tags}' AS tags, CAST({expr} AS BIGINT) AS failures"
        )

    ctes, parts = [], []
    for table, columns in never_null.items():
        ctes.append(f"checked_{table} AS MATERIALIZED ({sources[table]})")
        parts += [row(table, "not_null", c, f"(SELECT count(*) - count({c}) FROM checked_{table})") for c in columns.split(", ")]
        low = [c for c in never_negative.get(table, "").split(", ") if c]
        parts += [row(table, "expression_is_true", c, f"(SELECT count(*) FROM checked_{table} WHERE {c} < 0)") for c in low]
    for table in ("ref_ticker_info", "dim_summary_ticker_list"):
        parts.append(row(table, "unique", "ticker", f"(SELECT count(*) FROM (SELECT ticker FROM {table} WHERE ticker IS NOT NULL GROUP BY ticker HAVING count(*) > 1))"))
    types = "'指数', '株', '為替', '金利', 'Crypto', 'コモディティ', 'REIT'"
    parts.append(row("ref_ticker_info", "accepted_values", "asset_type", f"(SELECT count(DISTINCT asset_type) FROM ref_ticker_info WHERE asset_type NOT IN ({types}))"))
    good = f"regexp_full_match(timestamp_jst, '{DATETIME_TEXT}') AND TRY_CAST(timestamp_jst AS TIMESTAMP) IS NOT NULL"
    parts.append(row("raw_trade_history", "is_datetime", "timestamp_jst", f"(SELECT count(*) FROM raw_trade_history WHERE timestamp_jst IS NOT NULL AND NOT ({good}))", "warn", "raw,format"))
    return ",\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


def _aum_cte() -> str:
    """Cash from one list of signed movements, and what is held."""
    a = D(AS_OF)
    return f""", aum AS (
  SELECT account, 'cash' AS ticker, 'cash' AS asset_type, 'cash' AS asset_name, {MSUM('moved')} AS position, CAST(1 AS DOUBLE) AS value_price,
    {MSUM('moved')} AS current_value, {a} AS partition_date
  FROM (SELECT account, price * order_count * (CASE WHEN (trade_type = 'buy') = (ticker = 'cash') THEN 1 ELSE -1 END) AS moved
        FROM stg_trade_history WHERE trade_date <= {a} AND ticker IS NOT NULL)
  GROUP BY account
  UNION ALL BY NAME
  SELECT account, ticker, asset_type, asset_name, CAST(position AS DOUBLE) AS position, close_price AS value_price,
    close_price * position AS current_value, {a} AS partition_date
  FROM valued_asof
)"""


def _all_term_pl() -> str:
    """One list of trades and of positions as if sold at the close, summed by key."""
    a = D(AS_OF)
    return f"""
, moves AS (
  SELECT account, ticker, trade_type AS kind, price * order_count AS amount, NULL AS asset_type, NULL AS asset_name
  FROM stg_trade_history WHERE trade_date <= {a} AND ticker != 'cash'
  UNION ALL
  SELECT account, ticker, 'held', position * close_price, asset_type, asset_name FROM valued_asof
), totals AS (
  SELECT account, ticker, max(asset_type) AS asset_type, max(asset_name) AS asset_name,
    {MSUM('amount', "kind = 'buy'")} AS total_buy_amount, coalesce({MSUM('amount', "kind = 'sell'")}, 0) AS sell_amount_already,
    coalesce(max(amount) FILTER (kind = 'held'), 0) AS position_close_amount
  FROM moves GROUP BY account, ticker
)
SELECT *, sell_amount_already + position_close_amount AS total_sell_amount, total_sell_amount - total_buy_amount AS pl_amount_all_term,
  total_sell_amount / nullif(total_buy_amount, 0) - 1 AS pl_ratio_all_term, {a} AS partition_date
FROM totals"""


def _entry_watch() -> str:
    a = D(AS_OF)
    return f"""
SELECT entry_price >= close_price AS is_reached_entry_price, ticker, asset_name, add_date, entry_price, memo,
  CASE WHEN is_active_weekend THEN {a} ELSE {PW(a)} END AS recent_price_date, close_price AS recent_price, {a} AS base_date
FROM stg_entry_point LEFT JOIN ref_ticker_info USING (ticker) LEFT JOIN closing_entry USING (ticker)"""


def _stream_ctes() -> tuple[str, str]:
    """Two incremental runs as the streaming driver performs them: each batch recomputes from
    its earliest date to the latest date known, reading as far back as a value can come from."""
    split = D(STREAM_SPLIT)
    lo1 = f"(SELECT min(date) FROM raw_price_data WHERE date <= {split})"
    hi1 = f"(SELECT max(date) FROM raw_price_data WHERE date <= {split})"
    lo2 = f"(SELECT min(date) FROM raw_price_data WHERE date > {split})"
    hi2 = "(SELECT max(date) FROM raw_price_data)"
    back = 60  # more than any fill can reach
    return price_history_ctes("s1", (f"({lo1} - {back})", lo1, hi1)), price_history_ctes("s2", (f"({lo2} - {back})", lo2, hi2))


#: Columns of the published tables, as the catalog has to list them; what they mean is declared once.
CATALOG = {
    "dwh_price_history": "ticker:string ohlc_type:string price:double fetch_time_jst:timestamp_ntz base_date:date",
    "dwh_daily_position": "account:string ticker:string position:bigint avg_buy_price:double partition_date:date",
    "dm_daily_aum": "account:string ticker:string asset_type:string asset_name:string position:double value_price:double current_value:double partition_date:date",
    "dm_daily_position_value": "account:string ticker:string asset_type:string asset_name:string position:bigint avg_buy_price:double close_price:double "
    "unrealized_value:double unrealized_return_ratio:double partition_date:date",
    "dm_daily_all_term_pl": "account:string ticker:string asset_type:string asset_name:string total_buy_amount:double sell_amount_already:double "
    "position_close_amount:double total_sell_amount:double pl_amount_all_term:double pl_ratio_all_term:double partition_date:date",
    "dm_daily_summary": "ticker:string order_group:bigint order_index:bigint asset_name:string is_active_weekend:boolean recent_date:date prev_date:date "
    "date_7day_ago:date date_28day_ago:date price_recent_date:double price_prev_date:double price_7day_ago:double price_28day_ago:double diff_recent_prev:double "
    "diff_recent_7day:double diff_recent_28day:double rate_recent_prev:double rate_recent_7day:double rate_recent_28day:double base_date:date",
    "dm_max_price_monitor": "order_group:bigint order_index:bigint ticker:string asset_name:string recent_price_date:date recent_price:double "
    "max_price_3month:double max_price_date_3month:date max_price_6month:double max_price_date_6month:date max_price_1year:double max_price_date_1year:date base_date:date",
    "dm_watch_entry_point": "is_reached_entry_price:boolean ticker:string asset_name:string add_date:date entry_price:double memo:string recent_price_date:date "
    "recent_price:double base_date:date",
}


def _catalog() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = [(t, TABLE_DESCRIPTIONS[t], *c.split(":"), COLUMN_DESCRIPTIONS[c.split(":")[0]]) for t, columns in CATALOG.items() for c in columns.split()]
    values = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {values}) AS t(table_name, table_comment, column_name, column_type, column_comment)"


def oracle_sql() -> dict[str, str]:
    a = D(AS_OF)
    ratio = "(close_price - avg_buy_price) / avg_buy_price"
    sql = {
        "stg_prices": _with() + "\nSELECT * FROM stg_price_data",
        "stg_trades": _with() + "\nSELECT * FROM stg_trade_history",
        "stg_status": _with() + "\nSELECT * FROM stg_asset_status_history",
        "stg_entry_points": _with() + "\nSELECT * FROM stg_entry_point",
        "prev_weekday_dates": _with()
        + f"""
SELECT DISTINCT base_date, CAST(dayofweek(base_date) + 1 AS INTEGER) AS day_of_week, {PW('base_date')} AS prev_weekday,
  {PW('(base_date - 7)')} AS prev_weekday_7day_ago,
  CAST(base_date - INTERVAL 3 MONTH AS DATE) AS date_3month_ago, CAST(base_date - INTERVAL 12 MONTH AS DATE) AS date_1year_ago
FROM stg_price_data""",
        "asset_master": _with() + "\nSELECT * FROM asset_master",
        "latest_prices": _with() + "\nSELECT * FROM latest_prices",
        "price_history": _with(PH_PD) + "\nSELECT * FROM price_history_pd",
        "price_history_backfill": _with(PH_BF) + "\nSELECT * FROM price_history_bf",
        "close_prices": _with(PH_PD) + "\nSELECT * FROM close_pd",
        "cross_rates": _with(PH_PD) + "\nSELECT * FROM ph_cross_pd",
        "trades_with_cash": _with() + "\nSELECT * FROM trades_with_cash",
        "open_lots": _with(POS) + "\nSELECT * FROM positions_asof",
        "open_lots_cutoff": _with(POS_CUT) + "\nSELECT * FROM positions_cut",
        "open_lots_units": _with(POS) + "\nSELECT * FROM positions_asof",
        "open_lots_range": _with(POS) + "\nSELECT * FROM positions_asof",
        "position_value": _with(PH_BF, POS, VALUED)
        + f"""
SELECT account, ticker, asset_type, asset_name, position, avg_buy_price, close_price,
  (close_price - avg_buy_price) * position AS unrealized_value, {ratio} AS unrealized_return_ratio, {a} AS partition_date
FROM valued_asof""",
        "aum": _with(PH_BF, POS, VALUED, _aum_cte()) + "\nSELECT * FROM aum",
        "all_term_pl": _with(PH_BF, POS, VALUED) + _all_term_pl(),
        "daily_summary": _with(PH_BF) + _summary_select(False),
        "daily_summary_report": _with(PH_BF) + _summary_select(True),
        "period_high": _with(closing_ctes("high", "long_close", X.HIGHS_AS_OF, 366)) + _period_high(),
        "entry_watch": _with(PH_BF, closing_ctes("entry", "close_bf", AS_OF, 7)) + _entry_watch(),
        "price_check_report": _with() + _price_check(),
        "position_value_check": _with(PH_BF, POS)
        + f"""
SELECT account, ticker, asset_type, asset_name, position, avg_buy_price, price AS close_price,
  (close_price - avg_buy_price) * position AS unrealized_value, {ratio} AS unrealized_return_ratio, {a} AS partition_date
FROM positions_asof LEFT JOIN asset_master USING (ticker) LEFT JOIN (FROM close_bf WHERE base_date = {a}) USING (ticker)""",
        "weekday_price_report": _with(PH_BF)
        + f"""
SELECT ticker, base_date, {PW('base_date')} AS adjusted_date, ohlc_type, price
FROM price_history_bf WHERE base_date BETWEEN {D(REPORT_FROM)} AND {a} AND ohlc_type = 'close'
ORDER BY ticker, base_date DESC""",
        "price_upsert": _with(PH_PREV, PH_PD)
        + """
SELECT * FROM price_history_prev p
WHERE NOT EXISTS (SELECT 1 FROM price_history_pd c WHERE c.ticker = p.ticker AND c.base_date = p.base_date AND c.ohlc_type = p.ohlc_type)
UNION ALL
SELECT * FROM price_history_pd""",
        "streaming_price_history": _with(*_stream_ctes()) + "\nSELECT * FROM price_history_s1 UNION ALL SELECT * FROM price_history_s2",
        "net_position_check": _with(POS_CUT)
        + f"""
SELECT account, ticker, CAST(sum(position) AS BIGINT) AS position, CAST(sum(moved) AS BIGINT) AS net_position
FROM (
  SELECT account, ticker, position, NULL AS moved FROM positions_cut
  UNION ALL
  SELECT account, ticker, NULL, CASE WHEN trade_type = 'buy' THEN order_count ELSE -order_count END
  FROM stg_trade_history WHERE trade_date <= {D(CUT)} AND ticker != 'cash'
) GROUP BY account, ticker HAVING coalesce(sum(position), 0) <> coalesce(sum(moved), 0)""",
    }
    for name, report, order in (
        ("daily_summary_ranked", "daily_summary_report", "order_group, order_index, ticker"),
        ("price_check_ranked", "price_check_report", "ticker, base_date, ohlc_type"),
        ("weekday_price_ranked", "weekday_price_report", "ticker, base_date DESC"),
    ):
        sql[name] = f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql[report]})"
    sql["catalog_descriptions"] = _catalog()
    sql["quarantine"] = f"""
WITH landed AS (
  SELECT p_partkey % 13 = 0 AS no_price, p_partkey % 17 = 0 AS more, {TK('p_partkey % 40')} AS ticker, CAST(p_size AS DOUBLE) * 8 AS entry_price, 'part ' || p_partkey AS memo FROM part
)
SELECT DATE '2024-01-02' AS add_date, ticker, entry_price, memo, NULL AS record, NULL AS reason FROM landed WHERE NOT no_price AND NOT more
UNION ALL
SELECT NULL, NULL, NULL, NULL, '2024-01-02,' || ticker || ',' || CASE WHEN no_price THEN 'n/a' ELSE entry_price::VARCHAR END || ',' || memo || CASE WHEN more THEN ',more' ELSE '' END,
  CASE WHEN no_price THEN 'entry_price: n/a' ELSE 'number of fields' END
FROM landed WHERE no_price OR more"""
    sql["period_high_blocks"] = sql["period_high"]
    sql["trailing_highs"] = _with() + """
SELECT x.ticker, x.base_date, max(y.price) AS max_price, min(y.base_date) FILTER (y.price IS NOT DISTINCT FROM top) AS max_price_date
FROM (
  SELECT ticker, base_date, max(price) OVER (PARTITION BY ticker ORDER BY base_date RANGE BETWEEN INTERVAL 99 DAY PRECEDING AND CURRENT ROW) AS top
  FROM long_close
) x JOIN long_close y ON x.ticker = y.ticker AND y.base_date BETWEEN x.base_date - 99 AND x.base_date
GROUP BY x.ticker, x.base_date"""
    for name in ("open_lots", "aum", "all_term_pl"):  # the same results, from the ledger tables
        sql[f"{name}_incremental"] = sql[name]
    plain = {n: f"SELECT * FROM {n}" for n in ("ref_ticker_info", "dim_summary_ticker_list", "stg_asset_status_history", "stg_trade_history", "stg_price_data", "stg_entry_point")}
    sql["quality_checks"] = _with() + _checks(
        plain
        | {
            "dwh_trade_history_with_cash": "SELECT * FROM trades_with_cash",
            "dwh_asset_master": "SELECT * FROM asset_master",
            "dwh_price_history": sql["price_history"],
            "dwh_daily_position": sql["open_lots"],
            "dm_daily_aum": sql["aum"],
            "dm_daily_position_value": sql["position_value"],
            "dm_daily_all_term_pl": sql["all_term_pl"],
            "dm_daily_summary": sql["daily_summary"],
            "dm_watch_entry_point": sql["entry_watch"],
        }
    )
    return sql
