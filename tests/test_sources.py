import pytest
from pyspark.sql import functions as F

from kabuto.functions.columns import DASH_DATETIME  # noqa: F401
from kabuto.operators import checks as Q
from kabuto.operators.ranks import with_position
from kabuto.plans import daily
from kabuto.plans.reports import daily_summary_report, price_check_report, weekday_price_report  # noqa: F401
from kabuto.session import scratch_path
from kabuto.sources import descriptions as C
from kabuto.sources.raw import raw_sources, read_quarantined, read_raw
from tests.conftest import D, rows


def _land(spark, name, lines, header=True):
    base = scratch_path(spark, "landed")
    head = ["date,ticker,ohlc_type,price,fetch_time_str"] if header else []
    spark.createDataFrame([(x,) for x in [*head, *lines]], "value string").coalesce(1).write.text(f"{base}/{name}")
    return base


LINES = [
    "2024-01-05,X,close,10.5,2024-01-05 15:00:00",
    "2024-01-05,Y,close,,",  # empty fields are NULL, not bad
    "2024-01-06,X,close,ten,2024-01-06 15:00:00",
    "yesterday,X,close,1.0,t",
    "2024-01-07,X,close,1.0,t,more",
    "2024-01-08,X",
    '2024-01-09,"a ""b"", c",open,1e3,é',
]


def test_quarantine_keeps_every_record_once(spark):
    base = _land(spark, "raw_price_data", LINES)
    got = read_quarantined(spark, base, "raw_price_data")
    assert rows(got.good, "date", "ticker", "price") == [(D("2024-01-05"), "X", 10.5), (D("2024-01-05"), "Y", None), (D("2024-01-09"), 'a "b", c', 1000.0)]
    bad = {r.record: (r.reason, r.file) for r in got.bad.collect()}
    assert {k: v[0] for k, v in bad.items()} == {LINES[2]: "price: ten", LINES[3]: "date: yesterday", LINES[4]: "number of fields", LINES[5]: "number of fields"}
    assert all("raw_price_data/part-" in f for _, f in bad.values())
    found = got.check("raw_price_data").collect()[0]
    assert (found.table_name, found.check_name, found.failures, found.severity) == ("raw_price_data", "well_formed", 4, "warn")
    checks = Q.run_checks(got.good, [Q.not_null("date")], "t").unionByName(got.check("raw_price_data", "error"))
    with pytest.raises(Q.CheckFailed):
        Q.raise_on_failure(checks)
    with pytest.raises(Exception):  # the default reader fails on such a record
        read_raw(spark, base, "raw_price_data", "csv").collect()


def test_quarantine_without_bad_records(spark):
    got = read_quarantined(spark, _land(spark, "raw_price_data", LINES[:1]), "raw_price_data")
    assert got.good.count() == 1 and got.bad.count() == 0 and got.check("x").collect()[0].failures == 0


@pytest.mark.parametrize("n", [0, 1, 500])
def test_positions_are_places_in_the_order(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 1009).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("b")).repartition(6)
    got = with_position(df, [F.col("b").desc(), "a"]).collect()
    order = sorted(got, key=lambda r: (-(r.b if r.b is not None else -1), r.a))
    assert [r.position for r in sorted(got, key=lambda r: r.position)] == list(range(1, n + 1))
    assert [(r.b, r.a) for r in sorted(got, key=lambda r: r.position)] == [(r.b, r.a) for r in order]


def test_reports_come_in_their_order(spark):
    """O1 to O3: what a report collects to is sorted by its columns."""
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    q = E.queries()
    key = lambda r, *cols: tuple((r[c] is not None, r[c]) for c in cols)
    got = q["daily_summary_report"](spark, sf).collect()
    assert [key(r, "order_group", "order_index") for r in got] == sorted(key(r, "order_group", "order_index") for r in got) and len(got) > 100
    got = q["price_check_report"](spark, sf).collect()
    assert [key(r, "ticker", "base_date") for r in got] == sorted(key(r, "ticker", "base_date") for r in got) and len(got) > 100
    got = [(r.ticker, -r.base_date.toordinal()) for r in q["weekday_price_report"](spark, sf).collect()]
    assert got == sorted(got) and len(got) > 20


def test_catalog_lists_every_table_and_column_with_its_comment(spark):
    import __spark_entry__ as E

    got = E.queries()["catalog_descriptions"](spark, "/root/testdata/sf0.001").collect()
    assert {r.table_name: r.table_comment for r in got} == C.TABLE_DESCRIPTIONS
    assert all(r.column_comment == C.COLUMN_DESCRIPTIONS[r.column_name] for r in got)
    assert {r.table_name for r in got} == set(daily.TABLES)
    shown = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE default.dm_max_price_monitor").collect()}
    assert shown["max_price_date_6month"] == "Earliest date of the highest close in the last six months"
    assert spark.table("default.dm_max_price_monitor").count() > 0


def test_is_datetime_with_valid_and_invalid_text(spark):
    good = ["2024-01-02", "2024-1-2 3:4:5", "2024-01-02T03:04:05.123456", "2024-02-29 00:00:00"]
    bad = ["2024/01/02 00:00:00", "2024-02-30", "2024-01-02 25:00:00", "soon", ""]
    df = spark.createDataFrame([(x,) for x in [*good, *bad, None]], "ts string")
    assert Q.run_checks(df, [Q.is_datetime("ts")], "t").collect()[0].failures == len(bad)


def test_all_sources_from_a_base_path(spark):
    """The readers of a run: feeds below a base path, dimensions as CSV files."""
    import __spark_entry__  # noqa: F401
    from kabuto.sources import fixtures as X
    from kabuto.sources.schemas import RAW_TABLES, SEED_TABLES

    base, seeds = scratch_path(spark, "raw"), scratch_path(spark, "seeds")
    fixed = X.load(spark, "/root/testdata/sf0.001")
    for name in RAW_TABLES:
        if name in fixed:
            fixed[name].write.parquet(f"{base}/{name}")
    for name in SEED_TABLES:
        fixed[name].coalesce(1).write.option("header", True).csv(f"{seeds}/{name}.csv")
    read = raw_sources(spark, base, seeds)
    for name, df in read.items():
        assert df.count() == fixed[name].count() and set(df.columns) == set(fixed[name].columns)
