"""Dimension enrichment with a size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we hint as broadcast, by the planner's size estimate of its analysed plan. For a Parquet
# table that is the size of its files; its rows take five to ten times that on the driver, which collects
# them and builds the hash table. Seeds hold tens of rows; anything past this bound is joined as the planner
# sees fit (and AQE may still broadcast it if its real size turns out small).
BROADCAST_MAX_BYTES = 8 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of the size of ``df`` (no job runs). Unknown sizes are huge."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if its estimated size is at most ``max_bytes``, else ``df`` unhinted."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def enrich(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], columns: Sequence[str], small: bool = True) -> DataFrame:
    """Left join ``columns`` of ``dim`` onto ``fact`` by ``key``; unmatched rows get NULLs."""
    keys = [key] if isinstance(key, str) else list(key)
    if small:
        dim = bounded_broadcast(dim)
    return fact.join(dim.select(*keys, *columns), keys, "left")
