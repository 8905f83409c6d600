"""Sharding (operator 6): constant-time placement from a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table (an offset and a step,
both hashed from its name; the prime size makes each order a permutation). The shards take turns,
each claiming its next free slot, until the table is full. Shares differ by at most one slot, and
a removed shard moves little besides its own slots.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import prepare

TABLE_SIZE = 65_537  # prime
MAX_TABLE = 1 << 22  # slots; the table is broadcast


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard index of each slot. ``shards``: distinct names, at most ``size`` of them.

    The order of the names doesn't matter: turns go by sorted name."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct names, at least one, at most one per slot")
    if not is_prime(size) or size > MAX_TABLE:
        raise ValueError(f"the table size must be a prime up to {MAX_TABLE}")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    at, step = {}, {}
    for i in turns:
        digest = hashlib.sha256(shards[i].encode()).digest()
        at[i] = int.from_bytes(digest[:8], "big") % size
        step[i] = int.from_bytes(digest[8:16], "big") % (size - 1) + 1 if size > 2 else 1
    table, free = [-1] * size, size
    while True:
        for i in turns:
            slot = at[i]
            while table[slot] >= 0:
                slot = (slot + step[i]) % size
            table[slot] = i
            at[i] = (slot + step[i]) % size
            free -= 1
            if not free:
                return table


def slot_of(key, size: int = TABLE_SIZE):
    """The slot of a key column: the first 60 bits of the MD5 of its text, modulo the size. A null
    key takes the slot of the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % F.lit(size)


def assign_shards(df: DataFrame, shards: list[str], key: str, size: int = TABLE_SIZE, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard name of every row, by the column ``key``.

    Rows with equal keys share a shard; null keys are placed as the empty text; columns already
    named ``slot_col`` or ``shard_col`` are replaced. No shuffle: the table (one row per slot, at
    most ``MAX_TABLE``) is broadcast, and every row is looked up in constant time.
    """
    spark = prepare(df.sparkSession)
    table = lookup_table(shards, size)
    slots = spark.createDataFrame([(k, shards[i]) for k, i in enumerate(table)], f"`{slot_col}` long, `{shard_col}` string")
    placed = df.drop(shard_col).withColumn(slot_col, slot_of(F.col(key), size))
    return placed.join(F.broadcast(slots), slot_col).select(*[c for c in placed.columns if c != slot_col], slot_col, shard_col)


def write_shards(df: DataFrame, path: str, shards: list[str], key: str, files_per_shard: int = 1, size: int = TABLE_SIZE) -> None:
    """Write ``df`` partitioned by shard; ``files_per_shard`` spreads each shard over that many
    tasks (by key hash), so a shard holding a hot key is not one task."""
    placed = assign_shards(df, shards, key, size)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_shard))
    placed.repartition(len(shards) * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path)
