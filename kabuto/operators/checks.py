"""Data-quality checks: declarative column checks run as one aggregation per table.

Each check counts failures the way the declarative test framework reports them:
  not_null            rows where the column is NULL
  accepted_values     distinct non-NULL values outside the list
  expression_is_true  rows where ``NOT (column <expr>)`` holds (NULL passes)
  is_datetime         rows whose text is not NULL yet not a datetime
  unique              distinct non-NULL values that occur more than once
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kabuto.functions.columns import as_date, try_parse_datetime


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    arg: object = None
    severity: str = "error"
    tags: tuple[str, ...] = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})"


def not_null(col: str, **kw) -> Check:
    return Check("not_null", col, **kw)


def unique(col: str, **kw) -> Check:
    return Check("unique", col, **kw)


def accepted_values(col: str, values: Sequence, **kw) -> Check:
    return Check("accepted_values", col, tuple(values), **kw)


def expression_is_true(col: str, expression: str, **kw) -> Check:
    return Check("expression_is_true", col, expression, **kw)


def is_datetime(col: str, **kw) -> Check:
    return Check("is_datetime", col, **kw)


# Canonical DATETIME text: date with dashes, optional time (seconds and fraction optional).
CANONICAL_DATETIME = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,6})?)?)?$"

RESULT_SCHEMA = "table_name string, check_name string, column_name string, severity string, tags string, failures long"


def _row_failure(c: Check) -> Column:
    col = F.col(c.column)
    if c.kind == "not_null":
        return F.count(F.when(col.isNull(), 1))
    if c.kind == "expression_is_true":
        return F.count(F.when(~F.expr(f"`{c.column}` {c.arg}"), 1))
    if c.kind == "is_datetime":
        ok = col.rlike(CANONICAL_DATETIME) & try_parse_datetime(col).isNotNull()
        return F.count(F.when(col.isNotNull() & ~ok, 1))
    if c.kind == "accepted_values":
        return F.count_distinct(F.when(~col.isin(list(c.arg)), col))
    raise ValueError(c.kind)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """One row per check: (table_name, check_name, column_name, severity, tags, failures).

    Row-level checks share one aggregation over ``df``; each ``unique`` check is one grouped
    aggregation (partial, map-side) over the non-NULL values.
    """
    spark = df.sparkSession
    row_checks = [c for c in checks if c.kind != "unique"]
    parts = []
    if row_checks:
        agg = df.agg(*[_row_failure(c).cast(T.LongType()).alias(f"_f{i}") for i, c in enumerate(row_checks)])
        stack = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c.kind).alias("check_name"),
                        F.lit(c.column).alias("column_name"),
                        F.lit(c.severity).alias("severity"),
                        F.lit(",".join(c.tags)).alias("tags"),
                        F.col(f"_f{i}").alias("failures"),
                    )
                    for i, c in enumerate(row_checks)
                ]
            )
        )
        parts.append(agg.select(stack.alias("r")).select(F.lit(table).alias("table_name"), "r.*"))
    for c in checks:
        if c.kind == "unique":
            dups = (
                df.filter(F.col(c.column).isNotNull())
                .groupBy(c.column)
                .count()
                .filter(F.col("count") > 1)
                .agg(F.count(F.lit(1)).cast(T.LongType()).alias("failures"))
            )
            parts.append(
                dups.select(
                    F.lit(table).alias("table_name"),
                    F.lit(c.kind).alias("check_name"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.severity).alias("severity"),
                    F.lit(",".join(c.tags)).alias("tags"),
                    "failures",
                )
            )
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ObservedChecks:
    """Row checks counted while a frame is written (``DataFrame.observe``): no scan of their own.

    ``observe(df)`` gives the frame to write; after the write, ``results`` has the rows of ``run_checks``.
    Counts of distinct values can't be observed; ``rest`` are the checks left to ``run_checks``. Where the frame
    is shuffled after it is observed, a task that runs again counts its rows again: a count can
    then be too high, but none is where no row fails.
    """

    KINDS = ("not_null", "expression_is_true", "is_datetime")

    def __init__(self, checks: Sequence[Check], table: str, failures: dict[Check, Column] | None = None):
        self.table = table
        self.checks = [c for c in checks if c.kind in self.KINDS]
        self.rest = [c for c in checks if c.kind not in self.KINDS]
        self.failures = failures or {}
        self.observation = Observation()

    def observe(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        return df.observe(self.observation, *[self.failures.get(c, _row_failure(c)).cast(T.LongType()).alias(f"_f{i}") for i, c in enumerate(self.checks)])

    def results(self, spark: SparkSession) -> DataFrame:
        seen = self.observation.get if self.checks else {}
        rows = [(self.table, c.kind, c.column, c.severity, ",".join(c.tags), seen.get(f"_f{i}") or 0) for i, c in enumerate(self.checks)]
        return spark.createDataFrame(rows, RESULT_SCHEMA)


class CheckFailed(AssertionError):
    pass


def raise_on_failure(results: DataFrame) -> None:
    """Raise when a check of severity ``error`` has failures (collects one row per check)."""
    bad = results.filter((F.col("severity") == "error") & (F.col("failures") > 0)).collect()
    if bad:
        raise CheckFailed("; ".join(f"{r['table_name']}.{r['check_name']}({r['column_name']}): {r['failures']}" for r in bad))


def net_position_mismatches(
    positions: DataFrame,
    net: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("account", "ticker"),
    partition_col: str = "partition_date",
) -> DataFrame:
    """Reconcile stored positions at ``as_of`` against the net traded quantity per key.

    Full outer join on the keys; a row is returned when ``coalesce(position, 0)`` differs from
    ``coalesce(net_position, 0)`` (a key on one side only counts as 0 on the other)."""
    keys = list(keys)
    d = positions.filter(F.col(partition_col) == as_date(as_of)).select(*keys, "position")
    j = d.join(net, keys, "full")
    return j.filter(F.coalesce("position", F.lit(0)) != F.coalesce("net_position", F.lit(0))).select(*keys, "position", "net_position")
