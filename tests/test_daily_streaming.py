import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kabuto.plans.daily import run_daily
from kabuto.session import scratch_path
from kabuto.sources import fixtures as X
from kabuto.sources.schemas import RunDates
from kabuto.streaming import price_history_batch_handler, raw_price_stream, run_incremental
from tests.conftest import D, rows
from tools.compare import digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")


def test_two_daily_runs_publish_and_match_the_mart_query(spark):
    root = scratch_path(spark, "daily")
    raw = X.load(spark, SF)
    run_daily(spark, raw, RunDates.for_run_day(D("2024-01-28")), root, run_checks=False)
    out = run_daily(spark, raw, RunDates.for_run_day(D("2024-01-29")), root)
    dates = [r[0] for r in out["dwh_price_history"].select("base_date").distinct().orderBy("base_date").collect()]
    assert dates == [D("2024-01-25"), D("2024-01-26"), D("2024-01-27"), D("2024-01-28")]
    pv = out["dm_daily_position_value"].filter(F.col("partition_date") == D("2024-01-28"))
    q = E.queries()["position_value"](spark, SF)
    assert digest([tuple(r) for r in pv.collect()], pv.columns) == digest([tuple(r) for r in q.collect()], q.columns)
    assert out["dwh_daily_position"].schema["avg_buy_price"].metadata.get("comment")
    for table, query in [("dm_daily_aum", "aum"), ("dm_daily_all_term_pl", "all_term_pl")]:  # flows path == direct path
        got = out[table].filter(F.col("partition_date") == D("2024-01-28"))
        want = E.queries()[query](spark, SF)
        assert digest([tuple(r) for r in got.collect()], got.columns) == digest([tuple(r) for r in want.collect()], want.columns)
    checks = {(r["table_name"], r["check_name"], r["column_name"]): r["failures"] for r in out["checks"].collect()}
    assert checks[("dwh_daily_position", "expression_is_true", "position")] == 0
    assert ("dwh_daily_position", "matches_net", "position") in checks


def test_streaming_runs_incremental_model_per_batch(spark):
    base = scratch_path(spark, "stream")
    feed, root, ckpt = f"{base}/raw", f"{base}/tables", f"{base}/ckpt"
    prices = X.raw_price_data(spark, SF)
    tickers = X.ref_ticker_info(spark, SF)
    prices.filter(F.col("date") <= D("2024-01-20")).write.mode("append").parquet(feed)
    handler = price_history_batch_handler(spark, feed, tickers, root)
    stream = raw_price_stream(spark, feed)
    run_incremental(stream, handler, ckpt).awaitTermination()
    first = spark.read.parquet(f"{root}/dwh_price_history")
    assert first.agg(F.max("base_date")).first()[0] == D("2024-01-20")
    prices.filter(F.col("date") > D("2024-01-20")).write.mode("append").parquet(feed)
    run_incremental(raw_price_stream(spark, feed), handler, ckpt).awaitTermination()
    table = spark.read.parquet(f"{root}/dwh_price_history")
    assert table.agg(F.min("base_date"), F.max("base_date")).first()[:] == (D("2024-01-01"), D("2024-01-30"))
    late = table.filter(F.col("base_date") > D("2024-01-20"))
    lo = D("2024-01-21")
    from kabuto.plans import staging, warehouse

    expect = warehouse.price_history(staging.price_rows(prices), tickers, RunDates(D("2024-01-30"), lo, lo - dt.timedelta(days=27)))
    assert rows(late, *expect.columns) == rows(expect)


def test_command_line_run_reads_feeds_and_csv_seeds(spark):
    from kabuto.__main__ import main
    from kabuto.sources.schemas import RAW_TABLES, SEED_TABLES

    base = scratch_path(spark, "cli")
    fx = X.load(spark, SF)
    for name in RAW_TABLES:
        if name in fx:
            fx[name].write.parquet(f"{base}/raw/{name}")
    for name in SEED_TABLES:
        fx[name].coalesce(1).write.option("header", True).csv(f"{base}/seeds/{name}.csv")
    argv = ["--raw", f"{base}/raw", "--seeds", f"{base}/seeds", "--tables", f"{base}/tables", "--run-day", "2024-01-29"]
    assert main(argv + ["--select", "dwh_price_history,dm_daily_summary", "--no-checks"]) == 0
    summary = spark.read.parquet(f"{base}/tables/dm_daily_summary")
    want = E.queries()["daily_summary"](spark, SF)
    assert summary.count() == want.count()
    # A later run of one mart reads the price history it does not rebuild.
    assert main(argv + ["--select", "dm_max_price_monitor", "--no-fail-on-check"]) == 0
    # Failed checks of severity error make the run, and the check command, exit with 1.
    assert main(["check", *argv, "--select", "ref_ticker_info"]) == 1
    assert main(["check", *argv, "--select", "ref_ticker_info", "--no-fail-on-check"]) == 0
    assert main(["check", *argv, "--select", "dm_daily_summary,dim_summary_ticker_list"]) in (0, 1)
    with pytest.raises(ValueError):
        main(["check", *argv, "--select", "dm_daily_aum"])
    assert spark.read.parquet(f"{base}/tables/dm_max_price_monitor").count() > 0


def test_views_are_queryable_by_name(spark):
    from kabuto.plans.daily import register_views

    register_views(spark, X.load(spark, SF))
    n = spark.sql("SELECT count(*) FROM dwh_trade_history_with_cash WHERE ticker = 'cash'").first()[0]
    assert n == spark.sql("SELECT count(*) FROM stg_trade_history").first()[0]  # every trade has one cash row
    assert spark.sql("SELECT count(DISTINCT ticker) = count(*) FROM dwh_asset_master").first()[0]


def test_a_run_reads_the_trades_three_times_and_leaves_no_scratch(spark):
    """Sample, sums and the lots that are cut; the checks are counted while tables are written."""
    root = scratch_path(spark, "daily")
    raw = dict(X.load(spark, SF))
    n = raw["raw_trade_history"].count()
    read = spark.sparkContext.accumulator(0)
    schema = raw["raw_trade_history"].schema

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    raw["raw_trade_history"] = raw["raw_trade_history"].mapInArrow(counted, schema)
    base = os.path.dirname(root).removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = run_daily(spark, raw, RunDates.for_run_day(D("2024-01-29")), root)
    assert read.value <= 3 * n
    got = {(r.table_name, r.check_name, r.column_name): r.failures for r in out["checks"].collect()}
    assert read.value <= 3 * n  # nor by looking at the checks
    assert set(os.listdir(base)) - before == {os.path.basename(root)}
    full = run_daily(spark, X.load(spark, SF), RunDates.for_run_day(D("2024-01-29")), scratch_path(spark, "daily"), check_all_partitions=True)
    want = {(r.table_name, r.check_name, r.column_name): r.failures for r in full["checks"].collect()}
    assert got.keys() == want.keys()
    assert {k: v for k, v in got.items() if k[0] != "stg_price_data"} == {k: v for k, v in want.items() if k[0] != "stg_price_data"}


def test_observed_checks_count_failing_rows(spark):
    trades = spark.createDataFrame(
        [(None, "X", None, 1, 2.0), ("a", "cash", "buy", None, 1.0), ("a", None, "buy", None, None), ("b", "Y", "sell", 3, None)],
        "account string, ticker string, trade_type string, order_count long, price double",
    ).withColumns({"event_time_jst": F.lit(None).cast("timestamp_ntz"), "trade_date": F.lit(D("2024-01-01")), "memo": F.lit("m")})
    from kabuto.operators import checks as Q
    from kabuto.plans import daily, warehouse
    from kabuto.plans.declared import DECLARED

    name = "dwh_trade_history_with_cash"
    seen = Q.ObservedChecks(DECLARED[name], name, daily._mirrored_failures())
    seen.observe(trades).write.format("noop").mode("overwrite").save()
    want = Q.run_checks(warehouse.trade_history_with_cash(trades), DECLARED[name], name)
    assert rows(seen.results(spark)) == rows(want)
    assert sum(r.failures for r in want.collect()) > 10


def test_a_failed_overwrite_keeps_the_table(spark, monkeypatch):
    """Partitions that a run empties are removed after the overwrite; if this fails, all is as it was."""
    from kabuto.operators import upsert as U

    schema = "account string, ticker string, position long, partition_date date"
    keys = ["account", "ticker", "partition_date"]
    path = scratch_path(spark, "upsert")
    old = spark.createDataFrame([("A", "X", 1, D("2024-01-01")), ("A", "X", 2, D("2024-01-02"))], schema)
    U.upsert_partitions(spark, old, path, keys, "partition_date")
    new = spark.createDataFrame([("A", "X", 3, D("2024-01-02"))], schema)
    days = [D("2024-01-01"), D("2024-01-02")]
    monkeypatch.setattr(U, "delete_path", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        U.upsert_partitions(spark, new, path, keys, "partition_date", replace_partition=True, partitions=days)
    assert rows(U.read_table(spark, path, old.schema), "position") == [(1,), (3,)]  # the overwrite is done, nothing is lost
    monkeypatch.undo()
    U.upsert_partitions(spark, new, path, keys, "partition_date", replace_partition=True, partitions=days)
    assert rows(U.read_table(spark, path, old.schema), "position") == [(3,)]
