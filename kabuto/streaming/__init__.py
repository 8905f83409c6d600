"""Structured Streaming driver for the incremental models (new raw files -> recompute -> upsert)."""

from kabuto.streaming.incremental import price_history_batch_handler, raw_price_stream, run_incremental  # noqa: F401
