"""Keep-latest-per-key (the ``ROW_NUMBER() OVER (... ORDER BY x DESC) = 1`` pattern)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose aggregation buffers have a fixed width, so that they are kept in a hash table.
FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order_desc`` values, compared left to
    right, each descending with NULLs last. Remaining columns break exact ties, so the pick is
    deterministic.

    One aggregate for each column after the first: the rows of equal (keys, columns so far) keep
    the largest value of the next, from the last column to the first. Where all columns have a
    fixed width these are hash aggregates with a partial (map-side) step, so a key repeated a
    million times is reduced before the shuffle and nothing is sorted; other types go through
    ``max(struct(...))``, which sorts.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_desc]
    ranked = [*order_desc, *rest]
    if not all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in ranked) or len(ranked) > 3:
        best = F.max(F.struct(*[F.col(c) for c in ranked])).alias("_best")
        return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in ranked]).select(*df.columns)
    out = df
    for k in range(len(ranked) - 1, -1, -1):
        # Among rows that agree in the keys and the columns before column k, its largest value stays
        # and the columns behind it follow (one row for each value is left by now). NULL comes
        # last: the row with a NULL counts only if there is no other.
        before, column, behind = ranked[:k], F.col(ranked[k]), ranked[k + 1 :]
        follow = [F.when(F.max(column).isNotNull(), F.max_by(c, column)).otherwise(F.max(F.when(column.isNull(), F.col(c)))).alias(c) for c in behind]
        out = out.groupBy(*keys, *before).agg(F.max(column).alias(ranked[k]), *follow)
    return out.select(*df.columns)
