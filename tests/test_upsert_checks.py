import pytest
from pyspark.sql import functions as F

from kabuto.operators import checks as Q
from kabuto.operators.upsert import DuplicateKeyError, read_table, upsert_partitions
from kabuto.session import scratch_path
from tests.conftest import D, rows

SCHEMA = "account string, ticker string, position long, partition_date date"
KEYS = ["account", "ticker", "partition_date"]


def test_upsert_replaces_inserts_keeps(spark):
    path = scratch_path(spark, "upsert")
    first = spark.createDataFrame(
        [("A", "X", 1, D("2024-01-01")), ("A", "Y", 2, D("2024-01-01")), ("A", "X", 3, D("2024-01-02"))], SCHEMA
    )
    upsert_partitions(spark, first, path, KEYS, "partition_date")
    batch = spark.createDataFrame([("A", "X", 30, D("2024-01-02")), ("B", "X", 4, D("2024-01-02"))], SCHEMA)
    touched = upsert_partitions(spark, batch, path, KEYS, "partition_date")
    assert touched == [D("2024-01-02")]
    got = rows(read_table(spark, path, first.schema), *first.columns)
    assert got == [
        ("A", "X", 1, D("2024-01-01")),
        ("A", "X", 30, D("2024-01-02")),
        ("A", "Y", 2, D("2024-01-01")),
        ("B", "X", 4, D("2024-01-02")),
    ]
    # Re-running the same batch changes nothing.
    upsert_partitions(spark, batch, path, KEYS, "partition_date")
    assert rows(read_table(spark, path, first.schema), *first.columns) == got


def test_upsert_never_deletes_unless_asked(spark):
    path = scratch_path(spark, "upsert")
    day = D("2024-01-02")
    upsert_partitions(spark, spark.createDataFrame([("A", "X", 1, day), ("A", "Y", 1, day)], SCHEMA), path, KEYS, "partition_date")
    rerun = spark.createDataFrame([("A", "X", 1, day)], SCHEMA)  # Y was closed by a late sell
    upsert_partitions(spark, rerun, path, KEYS, "partition_date")
    assert len(read_table(spark, path, rerun.schema).collect()) == 2  # stale Y row stays
    upsert_partitions(spark, rerun, path, KEYS, "partition_date", replace_partition=True)
    assert rows(read_table(spark, path, rerun.schema), "ticker") == [("X",)]


def test_upsert_rejects_duplicate_batch_keys(spark):
    path = scratch_path(spark, "upsert")
    dup = spark.createDataFrame([("A", "X", 1, D("2024-01-02")), ("A", "X", 2, D("2024-01-02"))], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert_partitions(spark, dup, path, KEYS, "partition_date")


def test_run_checks_counts(spark):
    df = spark.createDataFrame(
        [("a", "株", 1.0, "2024-01-01 00:00:00"), ("a", "bad", -1.0, "2024/01/01 00:00:00"), (None, "bad", None, None), ("b", None, 2.0, "x")],
        "ticker string, asset_type string, v double, ts string",
    )
    res = Q.run_checks(
        df,
        [
            Q.not_null("ticker"),
            Q.unique("ticker"),
            Q.accepted_values("asset_type", ["株", "REIT"]),
            Q.expression_is_true("v", ">= 0"),
            Q.is_datetime("ts", severity="warn", tags=("raw", "time")),
        ],
        "t",
    )
    got = {r["check_name"]: r["failures"] for r in res.collect()}
    assert {r["check_name"]: r["tags"] for r in res.collect()}["is_datetime"] == "raw,time"
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 1, "expression_is_true": 1, "is_datetime": 2}
    with pytest.raises(Q.CheckFailed):
        Q.raise_on_failure(res)
    Q.raise_on_failure(res.filter(F.col("check_name") == "is_datetime"))  # severity warn passes


def test_net_position_mismatch(spark):
    pos = spark.createDataFrame([("A", "X", 2, D("2024-01-02")), ("A", "Y", 1, D("2024-01-02"))], SCHEMA)
    net = spark.createDataFrame([("A", "X", 2), ("A", "Y", 2), ("A", "Z", -1), ("A", "W", 0)], "account string, ticker string, net_position long")
    got = rows(Q.net_position_mismatches(pos, net, D("2024-01-02")))
    assert got == [("A", "Y", 1, 2), ("A", "Z", None, -1)]
