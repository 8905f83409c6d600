"""Keyed upsert into a date-partitioned Parquet table.

Rows of the target equal to a batch row on ``keys`` are replaced, other batch rows inserted, and
all other target rows kept. Every key contains the partition column, so only partitions present
in the batch can change: those are read, merged and rewritten with dynamic partition overwrite;
nothing else in the table is touched. The first run (no table yet) is a plain partitioned write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kabuto.session import Scratch, delete_path


class DuplicateKeyError(ValueError):
    pass


def merge_batch(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merged content of the touched partitions: ``old`` minus rows keyed like ``new``, plus
    ``new``. NULL keys never match (such rows are always inserted and never replaced)."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*old.columns))


def existing_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``, or None if there is none yet; any other failure is raised."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as e:  # no table yet
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def table_missing(spark: SparkSession, path: str, schema) -> bool:
    return existing_table(spark, path, schema) is None


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"batch holds several rows for key {dict(zip(keys, dup[0][:-1]))}")


def upsert_partitions(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str,
    replace_partition: bool = False,
    check_unique: bool = True,
    partitions: Sequence = (),
) -> list:
    """Upsert ``new`` into the Parquet table at ``path``; returns the partitions written.

    ``replace_partition=True`` rewrites touched partitions with the batch only (drops rows the
    batch no longer produces, e.g. a position closed by a late sell). ``partitions`` then names
    the partitions that the batch stands for: those without a row in it are emptied, also when
    the batch has no row at all.

    A NULL partition value is a partition of its own: its stored rows are kept, as NULL keys
    never match.

    The batch is written once to a scratch table in the session's shared checkpoint folder, so its plan
    runs a single time for the key check, the partition list and the merge. The merged partitions are
    written there again before the overwrite: it never reads the files it replaces, and a lost
    executor recomputes from the scratch table, not from the target. A batch that replaces whole
    partitions is written from its own scratch table. The one step that changes the table is the overwrite;
    emptied partitions are removed after it, and a run that fails before that only has to be run
    again. Scratch tables are deleted at the end.
    """
    if partition_col not in keys:
        raise ValueError("the upsert key must contain the partition column")
    with Scratch(spark) as scratch:
        return _upsert(spark, scratch, scratch.write(new, "batch"), path, keys, partition_col, replace_partition, check_unique, partitions)


def _upsert(spark: SparkSession, scratch: Scratch, new: DataFrame, path: str, keys: Sequence[str], partition_col: str, replace_partition: bool, check_unique: bool, partitions: Sequence) -> list:
    # One job: rows per key, then per touched partition the largest count (bounded by the
    # number of partitions in the batch, i.e. by its date range).
    per_part = (
        new.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(partition_col)
        .agg(F.max("_n").alias("_n"))
        .collect()
    )
    if check_unique and any(r["_n"] > 1 for r in per_part):
        assert_unique(new, keys)
    touched = [r[partition_col] for r in per_part]
    order = lambda values: sorted(values, key=lambda v: (v is not None, v))
    emptied = [p for p in partitions if p not in touched] if replace_partition else []
    old = existing_table(spark, path, new.schema) if touched or emptied else None
    if old is None:
        if touched:
            new.write.partitionBy(partition_col).parquet(path)
        return order(touched)
    if touched:
        merged = new
        if not replace_partition:
            present = F.col(partition_col).isin([p for p in touched if p is not None])
            if None in touched:
                present = present | F.col(partition_col).isNull()
            merged = scratch.write(merge_batch(old.filter(present), new, keys), "merged")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    for value in emptied:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        delete_path(spark, f"{path.rstrip('/')}/{partition_col}={name}")
    return order([*touched, *emptied])


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
