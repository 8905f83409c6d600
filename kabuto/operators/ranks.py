"""Global positions of sorted rows without a window over all of them.

A sort range-partitions the rows; the number of rows in each range and its prefix sums give where a range
begins, and a row's place inside its range is its place in the sorted partition. No task holds more than a
range, and what is summed up is one row a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kabuto.session import scratch_path

_IN_PARTITION = (1 << 33) - 1  # the bits of monotonically_increasing_id that count inside a partition


def with_position(df: DataFrame, order: Sequence[str | Column], out: str = "position") -> DataFrame:
    """``df`` with the place of every row in ``order`` (from 1). Rows that ``order`` doesn't tell apart get
    places of their own, in any order: give a total one. The sorted rows are written once to the shared
    checkpoint folder, so that counts and rows come from the same sort."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    placed = df.orderBy(*order).select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias("_i"))
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    counts = stored.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return stored.join(F.broadcast(starts), "_p").select(*df.columns, (F.col("_start") + F.col("_i") + 1).alias(out))
