"""Run the incremental price model as new raw files land.

The raw price feed is appended on a schedule and may repeat or arrive late. Instead of a fixed
"last 3 days" window, a file-source stream picks up whatever arrived since the last run
(``trigger(availableNow=True)`` gives exactly-once, restartable batch runs from the checkpoint),
and for each micro-batch the dates it touches are recomputed from the full raw feed and
upserted. The published table therefore converges to the batch model's result however late a
row arrives.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kabuto.operators.upsert import existing_table
from kabuto.plans import staging, warehouse
from kabuto.plans.daily import publish
from kabuto.sources.schemas import FILL_MAX_ROWS, RAW_PRICE_DATA, RUN_IN_DAYS, RunDates

LOOKBACK_DAYS = RUN_IN_DAYS  # as far back as a filled cross rate can come from
REACH_DAYS = RUN_IN_DAYS  # and as far ahead as a new value can be carried


def raw_price_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Streaming scan of the raw price feed directory (fixed schema, new files only)."""
    return spark.readStream.schema(RAW_PRICE_DATA).format(fmt).load(path)


def price_history_batch_handler(
    spark: SparkSession,
    raw_path: str,
    ticker_info: DataFrame,
    root: str,
    fmt: str = "parquet",
) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: recompute and upsert the price history over the dates a batch touches.

    Touched range: from the earliest date in the batch to ``REACH_DAYS`` after the latest, as far
    as a new value can be carried, but not beyond the latest date known (batch or table).
    """

    def handle(batch: DataFrame, epoch_id: int) -> None:
        span = batch.filter(F.col("date").isNotNull()).agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        if span is None or span["lo"] is None:
            return
        lo, hi = span["lo"], span["hi"]
        table = f"{root.rstrip('/')}/dwh_price_history"
        published = existing_table(spark, table, None)  # None on the first run; other errors are raised
        known = None
        if published is not None:  # the latest date after the batch (partition pruning: usually nothing to read)
            known = published.filter(F.col("base_date") > F.lit(hi)).agg(F.max("base_date")).first()[0]
        as_of = min(max(hi, known), hi + dt.timedelta(days=REACH_DAYS)) if known else hi
        dates = RunDates(as_of, lo, lo - dt.timedelta(days=LOOKBACK_DAYS))
        feed = spark.read.schema(RAW_PRICE_DATA).format(fmt).load(raw_path)
        rows = staging.price_rows(feed.filter(F.col("date").between(F.lit(dates.history_from), F.lit(dates.as_of))))
        publish(spark, warehouse.price_history(rows, ticker_info, dates, max_rows=FILL_MAX_ROWS), root, "dwh_price_history")

    return handle


def run_incremental(
    stream: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream with ``handler`` per micro-batch. ``available_now`` processes what has
    landed and stops (a scheduled run); otherwise it keeps running on a 1-minute trigger."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
