"""Queries that read a feed many times read it from a table that is written once."""

import pytest

from kabuto.plans import catalog
from tests.conftest import rows


@pytest.fixture
def small(spark, tmp_path):
    tables = {
        "lineitem": ([(n % 9, n, float(n % 5), 10.0 + n, "R" if n % 4 == 0 else "N", None) for n in range(60)], "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(n, n, 5.0 * n, None) for n in range(9)], "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"),
        "events": ([(1, None, 3, "view", 7.0)], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"),
        "part": ([(3, "p", 2)], "p_partkey bigint, p_name string, p_size int"),
        "customer": ([(n, f"c{n}", "BUILDING") for n in range(9)], "c_custkey bigint, c_name string, c_mktsegment string"),
    }
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema)
        for c in ("l_shipdate", "o_orderdate"):
            if c in df.columns:
                df = df.selectExpr(*[f"TIMESTAMP_NTZ'1996-03-04 05:06:07' AS {c}" if x == c else x for x in df.columns])
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_landed_rows_are_the_same(spark, small):
    i = catalog.Inputs(spark, small)
    before = i.raw("raw_trade_history")
    after = i.landed("raw_trade_history")
    assert i.raw("raw_trade_history") is after and after.dtypes == before.dtypes
    assert rows(after) == rows(before) and after.count() == 69


def test_the_checks_join_the_trades_once(spark, small):
    read = catalog.queries()["quality_checks"](spark, small).inputFiles()
    assert not any("lineitem.parquet" in f for f in read) and any("landed-raw_trade_history" in f for f in read)
