"""Readers for the raw feeds and CSV dimensions.

The location of the raw tables depends on the environment (dev/prod), so every reader takes a
base path; nothing is hard-coded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kabuto.sources.schemas import RAW_TABLES, SEED_TABLES


def read_raw(spark: SparkSession, base_path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one raw feed (``raw_trade_history`` etc.) stored at ``{base_path}/{name}`` with its fixed schema."""
    schema = RAW_TABLES[name]
    reader = spark.read.schema(schema)
    if fmt == "csv":  # a value that does not fit its type fails the read; it must not turn into NULL
        reader = reader.option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
    return reader.format(fmt).load(f"{base_path.rstrip('/')}/{name}")


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Load a CSV dimension with a header row (UTF-8; values may be non-ASCII)."""
    return (
        spark.read.schema(SEED_TABLES[name])
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )


@dataclass(frozen=True)
class Quarantined:
    """A CSV feed, its rows that fit the schema apart from those that don't."""

    good: DataFrame
    bad: DataFrame  # record, file, reason

    def check(self, name: str, severity: str = "warn") -> DataFrame:
        """The number of bad rows as a check row (see ``operators.checks``)."""
        n = self.bad.agg(F.count(F.lit(1)).alias("failures"))
        return n.select(F.lit(name).alias("table_name"), F.lit("well_formed").alias("check_name"), F.lit("*").alias("column_name"), F.lit(severity).alias("severity"), F.lit("raw").alias("tags"), "failures")


def read_quarantined(spark: SparkSession, base_path: str, name: str, header: bool = True) -> Quarantined:
    """Scan one raw CSV feed and set the records aside that don't fit its schema: a value that doesn't
    parse, too few or too many fields. Nothing is dropped: each record (a line that isn't blank or the
    header) is in exactly one of the two; line breaks inside quotes aren't supported.

    ``reason`` names the first column whose text doesn't parse, or says that the number of fields is
    wrong. The default reader (``read_raw``) fails on such a record instead."""
    schema = RAW_TABLES[name]
    ddl = lambda fields: ", ".join(f"`{n}` {t}" for n, t in fields)
    names = ",".join(schema.names)
    lines = spark.read.text(f"{base_path.rstrip('/')}/{name}").select("value", F.col("_metadata.file_path").alias("file")).filter(F.trim("value") != "")
    if header:
        lines = lines.filter(F.col("value") != names)
    options = {"mode": "PERMISSIVE", "escape": '"', "columnNameOfCorruptRecord": CORRUPT}  # a quote inside a quoted field is doubled
    parsed = F.from_csv("value", ddl([(f.name, f.dataType.simpleString()) for f in schema.fields] + [(CORRUPT, "string")]), options)
    rows = lines.select("file", parsed.alias("r"), F.col("value").alias(CORRUPT)).select("file", *[F.col(f"r.{c}").alias(c) for c in schema.names], F.when(F.col(f"r.{CORRUPT}").isNotNull(), F.col(CORRUPT)).alias(CORRUPT))
    texts = F.from_csv(F.col(CORRUPT), ddl([(f.name, "string") for f in schema.fields]), {"mode": "PERMISSIVE", "escape": '"'})
    bad = rows.filter(F.col(CORRUPT).isNotNull()).withColumn("f", texts)
    wrong = F.lit(None).cast("string")
    for field in reversed(schema.fields):
        text = F.col(f"f.{field.name}")
        wrong = F.when(text.isNotNull() & F.col(field.name).isNull(), F.concat(F.lit(f"{field.name}: "), text)).otherwise(wrong)
    bad = bad.select(F.col(CORRUPT).alias("record"), "file", F.coalesce(wrong, F.lit("number of fields")).alias("reason"))
    return Quarantined(rows.filter(F.col(CORRUPT).isNull()).select(*schema.names), bad)


CORRUPT = "_corrupt_record"


# Declared feed without a consumer: its schema is kept, it is not read by a run.
UNUSED_FEEDS = {"raw_asset_name_master"}


def raw_sources(spark: SparkSession, base_path: str, seed_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All inputs of a daily run keyed by table name."""
    out = {n: read_raw(spark, base_path, n, fmt) for n in RAW_TABLES if n not in UNUSED_FEEDS}
    out.update({n: read_seed(spark, f"{seed_dir.rstrip('/')}/{n}.csv", n) for n in SEED_TABLES})
    return out
