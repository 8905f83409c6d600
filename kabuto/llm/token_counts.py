"""Token counts (operator 9): byte-pair merging with a heap and a linked list, counting only.

The symbols of a text are its characters (a character outside the vocabulary counts as its UTF-8
bytes). The adjacent pair of lowest rank, leftmost on ties, is popped from a heap and merged
until none is left; every merge takes one token off the count, so no identifiers are made.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm import pieces as P
from kabuto.llm.common import kept, prepare

CACHE_ENTRIES = 400_000  # segments kept per Python worker
CACHED_LENGTH = 48  # longer segments are counted anew each time


def merges(symbols: str, rank: dict[str, int]) -> int:
    """How many merges byte-pair encoding makes in ``symbols``.

    The linked list is kept by position: ``size[i]`` is the length of the symbol that starts at
    i (0: merged into one further left), so the next symbol starts at ``i + size[i]``.
    """
    n = len(symbols)
    heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(symbols[i : i + 2])) is not None]
    if not heap:
        return 0
    heapify(heap)
    size, before, done = [1] * n, list(range(-1, n - 1)), 0
    while heap:
        _, i, total = heappop(heap)
        left = size[i]
        j = i + left
        if not left or j >= n or left + size[j] != total:
            continue  # one of the two symbols has changed since
        size[j], size[i] = 0, total
        done += 1
        k = i + total
        if k < n:
            before[k] = i
            span = total + size[k]
            if (r := rank.get(symbols[i : i + span])) is not None:
                heappush(heap, (r, i, span))
        h = before[i]
        if h >= 0:
            span = size[h] + total
            if (r := rank.get(symbols[h : h + span])) is not None:
                heappush(heap, (r, h, span))
    return done


class Counts(dict):
    """Token count by segment; counted when first asked for."""

    def __init__(self, model: P.Model):
        super().__init__()
        self.model = model

    def __missing__(self, segment: str) -> int:
        ids = self.model.ids
        n = sum(1 if c in ids else len(c.encode()) for c in segment) - merges(segment, self.model.rank)
        if len(segment) <= CACHED_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[segment] = n
        return n


def count_text(text: str | None, counts: Counts) -> int:
    if not text:
        return 0
    return sum(map(counts.__getitem__, counts.model.split(counts.model.normalise(text))))


def token_counts(docs: DataFrame, model_path: str | None = None, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_bytes (UTF-8), n_tokens, over_limit
    (n_tokens > ``limit``); other columns are not read.

    A null text counts as empty (0 bytes, 0 tokens), a null id stays null, repeated rows are
    counted each. Whole texts of any length; no shuffle. Segments between exact cut points
    (``pieces.parse_model``) are counted once per worker while they stay in a bounded cache.
    """
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(P.read_model(model_path))

    def count(texts: pa.Array) -> pa.Array:
        parsed = P.model_of(model.value)
        mine = kept("pieces")
        counts = mine.get(("counts", id(parsed))) or mine.setdefault(("counts", id(parsed)), Counts(parsed))
        return pa.array([count_text(t.as_py(), counts) for t in texts], pa.int64())

    counted = F.arrow_udf(count, "long")
    text = F.col(text_col)
    return docs.select(
        F.col(id_col),
        F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"),
        counted(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
