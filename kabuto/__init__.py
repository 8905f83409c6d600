"""kabuto: batch operators for daily portfolio accounting and market-price analytics on PySpark.

Layers:
  sources    explicit schemas, run dates, raw/seed readers, test-data projections
  functions  Column-level helpers (date rollback, datetime parsing, safe division, money sums)
  operators  generic DataFrame -> DataFrame operators (latest per key, bounded fill, FIFO lots, ...)
  plans      the daily models (staging, warehouse, marts, reports) composed from the operators
  streaming  incremental driver that runs the batch models per arriving micro-batch
"""

__version__ = "0.1.0"
