"""Every registered query against its DuckDB oracle on the smallest driver tables, plus the
driver's smoke entry point."""

import os

import pytest

import __spark_entry__ as E
from duckdb_oracle import oracle_sql
from kabuto.plans.catalog import queries
from tools.compare import digest, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    sql = E.oracle_sql()[name]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, dcols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["account", "ticker"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())
