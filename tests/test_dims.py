import io
from contextlib import redirect_stdout

from kabuto.operators.dims import bounded_broadcast, enrich


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_broadcast_only_within_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).selectExpr("id % 10 as k", "id as v")
        small = spark.range(10).selectExpr("id as k", "id * 2 as w")
        assert "BroadcastHashJoin" in _plan(fact.join(bounded_broadcast(small, max_bytes=10_000), "k"))
        big = spark.range(11).selectExpr("id as k", "id * 2 as w")
        assert bounded_broadcast(big, max_bytes=10) is big  # above the bound: no hint
        assert "BroadcastHashJoin" not in _plan(fact.join(bounded_broadcast(big, max_bytes=10), "k"))
        # enrich keeps every fact row and leaves unmatched attributes NULL
        out = enrich(fact, big.filter("k < 5"), "k", ["w"]).filter("w is null").count()
        assert out == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_dimension_of_many_megabytes_is_not_broadcast_by_hint(spark):
    big = spark.range(2_000_000)  # 16 MB, which used to be hinted
    assert bounded_broadcast(big) is big
