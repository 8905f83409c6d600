import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kabuto.operators import ledger_state as S
from kabuto.operators.ledger import cash_balance, cash_from_flows, net_from_flows, net_units, totals_from_flows, trade_totals
from kabuto.operators.lots import open_lots
from kabuto.plans import catalog
from kabuto.session import scratch_path
from tests.conftest import D, rows
from tests.test_lots import SCHEMA, TIE_BREAK


def _log(n, seed):
    """Trades over five months, with NULL fields, cash, oversold keys and equal lots."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        day = None if rng.random() < 0.01 else D("2023-11-10") + dt.timedelta(days=rng.randrange(150))
        ticker = rng.choice(["X", "Y", "Z", "cash", None])
        side = rng.choice(["buy", "buy", "sell", "sell" if ticker == "Z" else "buy", None])
        out.append((day, ticker, side, rng.choice(["A", "B", None]), rng.choice([None, 0, 1, 2, 5]), rng.choice([None, 1.1, 2.25, 1e-9]), rng.choice(["m", f"m{i}"])))
    return out


def _same(spark, log, root, as_of):
    t = spark.createDataFrame(log, SCHEMA)
    flows = S.flows_at(spark, root, as_of)
    assert rows(S.open_lots_at(spark, t, root, as_of)) == rows(open_lots(t, as_of, tie_break=TIE_BREAK))
    assert rows(totals_from_flows(flows)) == rows(trade_totals(t, as_of))
    assert rows(cash_from_flows(flows)) == rows(cash_balance(t, as_of))
    assert rows(net_from_flows(flows)) == rows(net_units(t, as_of))


def test_runs_over_arrivals_equal_one_full_run(spark):
    """Three arrivals: what is dated so far, then later trades with late ones, then late ones only."""
    root = scratch_path(spark, "ledger")
    log = _log(400, 3)
    first = [r for r in log[:300] if r[0] is None or r[0] <= D("2024-02-10")]
    second = [r for r in log[:300] if r not in first] + log[300:350]
    late = [r for r in log[350:] if r[0] is not None and r[0] < D("2024-01-01")]
    seen = []
    for k, batch in enumerate((first, second, late)):
        seen += batch
        months = S.update_ledger(spark, spark.createDataFrame(seen, SCHEMA), spark.createDataFrame(batch, SCHEMA), root)
        assert months == sorted({r[0].replace(day=1) for r in batch if r[0]})
        for as_of in (D("2024-03-01"), D("2024-02-10")) if k < 2 else (D("2024-04-08"), D("2024-01-15"), D("2023-11-09")):
            _same(spark, seen, root, as_of)
    S.update_ledger(spark, spark.createDataFrame(seen, SCHEMA), spark.createDataFrame(seen[:50], SCHEMA), root)  # again
    _same(spark, seen, root, D("2024-03-31"))
    assert S.update_ledger(spark, spark.createDataFrame(seen, SCHEMA), spark.createDataFrame([], SCHEMA), root) == []


def test_a_late_trade_rewrites_one_month(spark):
    root = scratch_path(spark, "ledger")
    log = _log(200, 4)
    t = spark.createDataFrame(log, SCHEMA)
    S.update_ledger(spark, t, t, root)
    table = lambda name: spark.read.parquet(f"{root}/{name}")
    files = {name: {(r.month, r.f) for r in table(name).select("month", F.input_file_name().alias("f")).distinct().collect()} for name in (S.DAYS, S.MONTHS)}
    new = (D("2023-12-05"), "X", "buy", "A", 7, 3.0, "late")
    assert S.update_ledger(spark, spark.createDataFrame([*log, new], SCHEMA), spark.createDataFrame([new], SCHEMA), root) == [D("2023-12-01")]
    for name, before in files.items():
        after = {(r.month, r.f) for r in table(name).select("month", F.input_file_name().alias("f")).distinct().collect()}
        assert {m for m, _ in before ^ after} == {D("2023-12-01")}


def test_the_log_is_read_on_the_days_of_the_heads_only(spark):
    """With all other days of the log gone, the positions are the same."""
    root, path = scratch_path(spark, "ledger"), scratch_path(spark, "log")
    log = [r for r in _log(400, 5) if r[0]]
    t = spark.createDataFrame(log, SCHEMA)
    t.write.partitionBy("trade_date").parquet(path)
    S.update_ledger(spark, t, t, root)
    as_of = D("2024-03-20")
    expected = rows(open_lots(t, as_of, tie_break=TIE_BREAK))
    stored = spark.read.schema(SCHEMA).parquet(path)
    read = S.open_lots_at(spark, stored, root, as_of)
    days = {r[0] for r in stored.select("trade_date").distinct().collect()}
    sold = {(r.account, r.ticker): r.n for r in t.filter("trade_type = 'sell' AND trade_date <= DATE'2024-03-20'").groupBy("account", "ticker").agg(F.sum(F.greatest(F.coalesce("order_count", F.lit(0)), F.lit(0))).alias("n")).collect()}
    heads = set()
    for key, n in sold.items():
        done = 0
        for day in sorted(days):
            q = sum(max(r[4] or 0, 0) for r in log if (r[3], r[1]) == key and r[0] == day and r[2] == "buy")
            if None not in key and done < n < done + q:
                heads.add(day)
            done += q
    assert 0 < len(heads) < len(days) / 4
    only = stored.filter(F.col("trade_date").isin(list(heads)))
    assert rows(S.open_lots_at(spark, only, root, as_of)) == rows(read) == expected


def test_without_tables(spark):
    with pytest.raises(ValueError):
        S.flows_at(spark, scratch_path(spark, "none"), D("2024-01-01"))


def test_what_has_arrived_is_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    t = spark.createDataFrame(_log(60, 5), SCHEMA)
    root = scratch_path(spark, "ledger")
    for n in (1, 2):
        assert S.update_ledger(spark, t, t.mapInArrow(counted, t.schema), root)
        assert read.value == n * 60
    _same(spark, _log(60, 5), root, D("2024-03-01"))


def test_the_ledger_queries_read_the_test_tables_once(spark, monkeypatch):
    seen = []
    update = catalog.update_ledger
    monkeypatch.setattr(catalog, "update_ledger", lambda s, trades, arrived, root: seen.extend([trades, arrived]) or update(s, trades, arrived, root))
    i = catalog.Inputs(spark, "/root/testdata/sf0.001")
    catalog._ledger(i)
    assert len(seen) == 4
    for df in (*seen, i.trades):
        assert df.inputFiles() and not any("/lineitem.parquet" in f or "/orders.parquet" in f for f in df.inputFiles())
