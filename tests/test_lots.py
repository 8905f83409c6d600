import datetime as dt
import io
import math
import os
import random
import re
from contextlib import redirect_stdout

from hypothesis import given, settings
from hypothesis import strategies as st

from kabuto.operators import lots
from kabuto.operators.ledger import trade_flows
from kabuto.operators.lots import open_lots, open_lots_units
from kabuto.session import ensure_checkpoint_dir, scratch_path
from tests.conftest import D, rows

TIE_BREAK = ("memo", "price", "order_count")  # these trades have no time of day

SCHEMA = "trade_date date, ticker string, trade_type string, account string, order_count long, price double, memo string"
AS_OF = D("2024-01-31")


def _trades(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _both(spark, data, as_of=AS_OF):
    t = _trades(spark, data)
    fast = rows(open_lots(t, as_of, tie_break=TIE_BREAK))
    ranged = rows(open_lots(t, as_of, tie_break=TIE_BREAK, split="range", range_partitions=3))
    slow = rows(open_lots_units(t, as_of, tie_break=TIE_BREAK))
    assert ranged == fast
    return fast, slow


def test_fifo_partial_sell(spark):
    data = [
        (D("2024-01-01"), "X", "buy", "A", 10, 100.0, "1"),
        (D("2024-01-02"), "X", "buy", "A", 5, 200.0, "2"),
        (D("2024-01-03"), "X", "sell", "A", 12, 300.0, "3"),
    ]
    fast, slow = _both(spark, data)
    # 12 sold consume all 10 @100 and 2 @200; 3 @200 remain.
    assert fast == slow == [("A", "X", 3, 200.0, AS_OF)]


def test_oversold_zero_and_cutoff(spark):
    data = [
        (D("2024-01-01"), "X", "buy", "A", 2, 10.0, "1"),
        (D("2024-01-02"), "X", "sell", "A", 3, 10.0, "2"),  # oversold: no row
        (D("2024-01-01"), "Y", "buy", "A", 2, 10.0, "3"),
        (D("2024-01-02"), "Y", "sell", "A", 2, 10.0, "4"),  # flat: no row
        (D("2024-01-01"), "Z", "buy", "A", 4, 10.0, "5"),
        (D("2024-02-15"), "Z", "sell", "A", 4, 10.0, "6"),  # after the as-of date: ignored
        (D("2024-01-01"), "cash", "buy", "A", 4, 10.0, "7"),  # cash never has a position
    ]
    fast, slow = _both(spark, data)
    assert fast == slow == [("A", "Z", 4, 10.0, AS_OF)]


def test_empty_runs_null_price_and_null_account(spark):
    data = [
        (D("2024-01-01"), "X", "buy", "A", 0, 10.0, "1"),  # zero units
        (D("2024-01-01"), "X", "buy", "A", -3, 10.0, "2"),  # negative: empty run
        (D("2024-01-01"), "X", "buy", "A", None, 10.0, "3"),  # NULL: empty run
        (D("2024-01-02"), "X", "buy", "A", 2, None, "4"),  # NULL price: counted, not averaged
        (D("2024-01-03"), "X", "buy", "A", 2, 30.0, "5"),
        (D("2024-01-01"), "X", "buy", None, 3, 5.0, "6"),  # NULL account: sells never match it
        (D("2024-01-02"), "X", "sell", None, 3, 5.0, "7"),
        (D("2024-01-02"), "X", None, "A", 9, 5.0, "8"),  # NULL side: neither buy nor sell
    ]
    fast, slow = _both(spark, data)
    assert fast == slow == [(None, "X", 3, 5.0, AS_OF), ("A", "X", 4, 30.0, AS_OF)]


def test_same_day_ties_follow_tie_break(spark):
    data = [
        (D("2024-01-01"), "X", "buy", "A", 1, 50.0, "b"),
        (D("2024-01-01"), "X", "buy", "A", 1, 10.0, "a"),  # memo 'a' is first in FIFO order
        (D("2024-01-02"), "X", "sell", "A", 1, 0.0, "c"),
    ]
    fast, slow = _both(spark, data)
    assert fast == slow == [("A", "X", 1, 50.0, AS_OF)]


trade = st.tuples(
    st.integers(0, 20),  # day offset
    st.sampled_from(["X", "Y"]),
    st.sampled_from(["buy", "buy", "sell", None]),
    st.sampled_from(["A", "B", None]),
    st.one_of(st.none(), st.integers(-2, 6)),
    st.one_of(st.none(), st.sampled_from([1.25, 2.5, 10.0, 99.75])),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(trade, min_size=1, max_size=40))
def test_cumulative_equals_unit_expansion(spark, trades):
    base = D("2024-01-01")
    data = [
        (base + dt.timedelta(days=d), tk, side, acct, q, px, f"m{i:03d}")
        for i, (d, tk, side, acct, q, px) in enumerate(trades)
    ]
    random.shuffle(data)
    fast, slow = _both(spark, data, D("2024-01-15"))
    assert fast == slow


def test_range_split_on_one_hot_key_day(spark):
    day = D("2024-01-02")
    data = [(day, "X", "buy", "A", 1 + i % 3, float(10 + i), f"m{i:04d}") for i in range(300)]
    data += [(day, "X", "sell", "A", 250, 0.0, "s")]
    t = _trades(spark, data)
    ranged = rows(open_lots(t, AS_OF, tie_break=TIE_BREAK, split="range", range_partitions=16))
    assert ranged == rows(open_lots_units(t, AS_OF, tie_break=TIE_BREAK))


def _hot(spark, n=6000):
    """A third of all buys in one (key, day), another third of them equal lots on the next day."""
    day = D("2024-01-10")
    data = [(day, "X", "buy", "A", 1 + i % 4, float(10 + i % 90), f"m{i:05d}") for i in range(n // 3)]
    data += [(D("2024-01-11"), "X", "buy", "A", 2, 7.5, "same") for _ in range(n // 3)]
    data += [(D("2024-01-01") + dt.timedelta(days=i % 25), f"T{i % 40}", "buy", f"A{i % 7}", 1 + i % 3, 5.0 + i % 11, f"m{i:05d}") for i in range(n // 3)]
    data += [(D("2024-01-05") + dt.timedelta(days=i % 20), f"T{i % 40}", "sell", f"A{i % 7}", 2, 5.0, f"s{i:05d}") for i in range(n // 6)]
    return _trades(spark, data), n


def test_a_hot_day_is_split_by_literals(spark):
    trades, n = _hot(spark)
    cut = lots.fifo_splitters(trades, AS_OF, tie_break=TIE_BREAK, pieces=32)
    assert {r[0] for r in cut.rows} == {"2024-01-10"}  # no other day has distinct lots for two pieces
    assert 7 <= len(cut.rows) <= 12
    rows_of = trades.filter("trade_type = 'buy'").groupBy("account", "ticker", "trade_date", cut.piece().alias("p")).count()
    hot = [r["count"] for r in rows_of.filter("ticker = 'X' AND trade_date = DATE'2024-01-10'").collect()]
    assert sum(hot) == n // 3 and max(hot) < n // 10
    assert rows_of.filter("trade_date <> DATE'2024-01-10' AND p <> 0").isEmpty()
    for sold in (1, 700, 2000, 4999, 5500, 8000):  # the boundary in each of the hot groups
        more = trades.unionByName(_trades(spark, [(D("2024-01-12"), "X", "sell", "A", sold, 0.0, "z")]))
        assert rows(open_lots(more, AS_OF, tie_break=TIE_BREAK)) == rows(open_lots_units(more, AS_OF, tie_break=TIE_BREAK))


def test_pieces_put_nulls_first(spark):
    data = [(D("2024-01-02"), "X", "buy", "A", None if i % 5 == 0 else 1, None if i % 3 == 0 else float(i % 7), None if i % 2 else f"m{i % 4}") for i in range(200)]
    data += [(None, "X", "buy", "A", 4, 1.0, "m")]  # no date: never at or before a date
    data += [(D("2024-01-03"), "X", "sell", "A", 55, 1.0, "s")]
    t = _trades(spark, data)
    cut = lots.fifo_splitters(t, AS_OF, tie_break=TIE_BREAK, pieces=16)
    assert len(cut.rows) > 5
    flows = trade_flows(t, AS_OF, splitters=cut)
    expected = rows(open_lots_units(t, AS_OF, tie_break=TIE_BREAK))
    assert rows(open_lots(t, AS_OF, tie_break=TIE_BREAK, splitters=cut)) == expected
    assert rows(open_lots(t, AS_OF, tie_break=TIE_BREAK, splitters=cut, flows=flows)) == expected
    assert rows(open_lots(t, AS_OF, tie_break=TIE_BREAK, flows=trade_flows(t, AS_OF))) == expected


def test_prices_without_an_exact_value(spark):
    nan, inf = float("nan"), float("inf")
    data = [(D("2024-01-01"), f"T{k}", "buy", "A", 3, px, "m") for k, px in enumerate([nan, inf, 3e14, -2e20, 1e300, 99_999_999_999_999.0])]
    data += [(D("2024-01-02"), f"T{k}", "buy", "A", 1, 1.0, "m") for k in range(6)]
    got = {r.ticker: r.avg_buy_price for r in open_lots(_trades(spark, data), AS_OF, tie_break=TIE_BREAK).collect()}
    assert math.isnan(got["T0"]) and got["T1"] == inf and got["T2"] == (9e14 + 1) / 4 and got["T3"] == -1.5e20 and got["T4"] == 7.5e299
    assert got["T5"] == (3 * 99_999_999_999_999.0 + 1) / 4


def test_priced_lots_without_units_do_not_count(spark):
    data = [(D("2024-01-01"), "X", "buy", "A", 5, None, "1"), (D("2024-01-01"), "X", "buy", "A", 0, 1.0, "2")]
    assert rows(open_lots(_trades(spark, data), AS_OF, tie_break=TIE_BREAK)) == [("A", "X", 5, None, AS_OF)]


def test_plan_filters_lots_below_their_shuffle(spark):
    """The cut groups are a broadcast filter right above the scan of the lots, below any exchange of
    them; the sums behind both uses are computed once; nothing is checkpointed."""
    trades, _ = _hot(spark, 600)
    path = scratch_path(spark, "hot-trades")
    trades.write.parquet(path)
    before = set(os.listdir(ensure_checkpoint_dir(spark).replace("file:", "")))
    df = open_lots(spark.read.schema(SCHEMA).parquet(path), AS_OF, tie_break=TIE_BREAK)
    df.collect()
    assert set(os.listdir(ensure_checkpoint_dir(spark).replace("file:", ""))) == before
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    final = buf.getvalue().split("== Initial Plan ==")[0].splitlines()
    depth = lambda line: re.match("[ :+-]*", line).end()
    at = next(k for k, line in enumerate(final) if "BroadcastHashJoin" in line and "pmod(xxhash64(_k" in line)
    left = next(k for k in range(at + 1, len(final)) if "BroadcastQueryStage" in final[k] and depth(final[k]) == depth(final[at + 1]))
    below = final[at + 1 : left]  # the side of the lots
    assert any("FileScan" in line for line in below) and not any("Exchange" in line for line in below)
    assert sum("FileScan" in line for line in final) == 2  # the sums once, the lots once


def test_units_in_runs_over_many_blocks(spark, monkeypatch):
    """Runs of hundreds of millions of units: a row a unit could not be held."""
    many = 300_000_000
    data = [(D("2024-01-01"), "X", "buy", "A", many, 2.0, "1"), (D("2024-01-02"), "X", "buy", "A", 5, 4.0, "2"), (D("2024-01-03"), "X", "sell", "A", many - 3, 1.0, "3")]
    assert rows(open_lots_units(_trades(spark, data), AS_OF, tie_break=TIE_BREAK)) == [("A", "X", 8, 26.0 / 8, AS_OF)]
    monkeypatch.setattr(lots, "UNIT_BLOCK", 4)
    data = [(D("2024-01-01"), "X", "buy", None, 9, 5.0, "4"), (D("2024-01-02"), "X", "sell", None, 6, 5.0, "5")]
    for sold in (0, 1, 3, 4, 5, 8, 11, 12, 13, 40):  # the last sell before, at and behind the ends of blocks
        a = f"A{sold}"
        data += [(D("2024-01-01"), "X", "buy", a, 3, 2.0, "1"), (D("2024-01-02"), "X", "buy", a, 10, None if sold == 4 else 4.0, "2"), (D("2024-01-03"), "X", "sell", a, sold, 1.0, "3")]
    fast, slow = _both(spark, data)
    assert fast == slow and len(slow) == 9
