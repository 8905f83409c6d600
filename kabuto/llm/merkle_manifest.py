"""Merkle manifest of a table: a leaf a row, a tree a group, a tree over the groups' roots.

Concatenated-level strings: the leaves of a group are put in order and dealt into aligned blocks of
``BLOCK`` nodes. A block keeps each of its levels as ONE string of hex digests; the parents are the
hashes of its fixed-width substrings (two digests wide; the last may be one), the sibling of a node
is the substring that flanks it, empty if there is none. What is left of a block is one node of the
next round, whose blocks again hold ``BLOCK`` nodes, so a tree of any size takes a few rounds
(256 to the power of the round). The way down appends each block's siblings to those of its nodes,
and the groups' roots are the leaves of a last tree that is built by the same function.

Everything is SQL expressions on the JVM. No row is alone with its group: positions come from range
partitions of the order (counts by partition, offsets by prefix sums), blocks hold 256 nodes
whatever the size of a group. Texts are read once; what moves is digests.

Results in odd cases: null values hash as ``-``; an order of rows that agree in group and order
column goes by leaf; a null order value comes first, rows alike in everything are interchangeable;
a null group is a group, before all others; an empty table gives no rows; a table of one row has its
leaf as root and the hash of nothing as proof; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kabuto.llm.common import prepare, small_enough, written

LEVELS = 8  # of a block
BLOCK = 1 << LEVELS
HEX = 64  # characters of a digest
BROADCAST_GROUPS = 20_000  # roots (under 2 KB each) that are broadcast to the rows; more are shuffled


def value(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def record(columns: Sequence[Column]) -> Column:
    """The leaf of a row of such values."""
    return digest(*[value(c) for c in columns])


def _depth(n: Column) -> Column:
    """Levels above ``n`` nodes: the least d with 2**d >= n, in integers."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1))).cast("int")


def _positions(leaves: DataFrame) -> DataFrame:
    """(g, at, node, row) with the position of every node in its group and the group's size ``n``."""
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["g", F.col("first").asc_nulls_first(), "node", "tie"]
    ranged = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "merkle-ranged")
    counts = ranged.groupBy("g", "part").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = counts.select("g", "part", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"), F.sum("here").over(Window.partitionBy("g")).alias("n"))
    inside = Window.partitionBy("g", "part").orderBy(*order[1:])
    placed = ranged.withColumn("k", F.row_number().over(inside)).join(pieces, ["g", "part"])
    return placed.select("g", "n", (F.col("before") + F.col("k") - 1).alias("at"), "node", "row")


def _parents(level: Column) -> Column:
    """The hashes of the two-digest substrings of a level (the last may be one digest)."""
    pairs = F.ceil(F.octet_length(level) / F.lit(2 * HEX)).cast("int")
    return F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.sha2(F.substring(level, i * F.lit(2 * HEX) + 1, F.lit(2 * HEX)), 256))


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row a block: (g, n, block, up, rows, levels): ``up`` levels above its nodes, each a string
    of digests in ``levels``; ``row`` of the nodes in order."""
    grouped = nodes.groupBy("g", "n", F.shiftright("at", LEVELS).alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "node", "row"))).alias("nodes"))
    base = F.array_join(F.transform("nodes", lambda x: x["node"]), "").cast("binary")
    out = grouped.select("g", "n", "block", F.least(_depth(F.col("n")), F.lit(LEVELS)).alias("up"), F.transform("nodes", lambda x: x["row"]).alias("rows"), base.alias("level"))
    levels = [F.col("level")]
    # A level is computed once, as a column of its own: the next one refers to it.
    for k in range(LEVELS):
        name = f"level{k + 1}"
        out = out.withColumn(name, F.when(F.col("up") > k, F.array_join(_parents(levels[-1]), "").cast("binary")))
        levels.append(F.col(name))
    return out.select("g", "n", "block", "up", "rows", F.array(*levels).alias("levels"))


def _siblings(levels: Column, up: Column, i: Column) -> Column:
    """Of node ``i`` of a block: the digest that flanks its ancestor on every level, empty if none does."""

    def flank(k):
        sibling = F.call_function("shiftright", i, k).bitwiseXOR(F.lit(1))
        return F.substring(F.element_at(levels, k + 1), sibling * F.lit(HEX) + 1, F.lit(HEX)).cast("string")

    return F.when(up > 0, F.transform(F.sequence(F.lit(0), up - 1), flank)).otherwise(F.array().cast("array<string>"))


def _trees(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``leaves(g, first, node, row)``: for every leaf (g, at, node, row, siblings, top), its place, the
    digests beside its way up (empty where a node has none) and what remains of its group; and the
    latter for every group (g, top)."""
    nodes = written(_positions(leaves), "merkle-nodes")
    rounds, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = written(_blocks(nodes), f"merkle-blocks{len(rounds)}")
        rounds.append(blocks)
        most = math.ceil(most / BLOCK)
        if most <= 1:
            break
        node = F.element_at("levels", F.col("up") + 1).cast("string")
        # A group of one block ends here; its node goes on alone and stays as it is.
        nodes = blocks.select("g", F.ceil(F.col("n") / F.lit(BLOCK)).cast("long").alias("n"), F.col("block").alias("at"), node.alias("node"), F.lit(None).cast("struct<x:int>").alias("row"))
    # Down: what is above a block, from the last round to the first.
    last = rounds[-1]
    above = last.select("g", "block", F.array().cast("array<string>").alias("over"), F.element_at("levels", F.col("up") + 1).cast("string").alias("top"))
    for k in range(len(rounds) - 1, 0, -1):
        held = rounds[k].join(above, ["g", "block"])
        each = held.select("g", "block", "levels", "up", "over", "top", F.posexplode(F.transform("rows", lambda r: F.lit(1))).alias("i", "one"))
        above = each.select(
            "g",
            (F.col("block") * BLOCK + F.col("i")).alias("block"),
            F.concat(_siblings(F.col("levels"), F.col("up"), F.col("i")), "over").alias("over"),
            "top",
        )
        if k > 1:
            above = written(above, f"merkle-above{k}")
    each = rounds[0].join(above, ["g", "block"]).select("g", "block", "levels", "up", "over", "top", F.posexplode("rows").alias("i", "row"))
    rows = each.select(
        "g",
        (F.col("block") * BLOCK + F.col("i")).alias("at"),
        F.substring(F.element_at("levels", 1), F.col("i") * HEX + 1, F.lit(HEX)).cast("string").alias("node"),
        "row",
        F.concat(_siblings(F.col("levels"), F.col("up"), F.col("i")), "over").alias("siblings"),
        "top",
    )
    return rows, last.select("g", F.element_at("levels", F.col("up") + 1).cast("string").alias("top"))


def fold(leaf: Column, at: Column, siblings: Column) -> Column:
    """The root that ``leaf`` at position ``at`` gives with its siblings, bottom up."""
    start = F.struct(leaf.alias("h"), at.cast("long").alias("at"))

    def step(acc, s):
        left = acc["at"].bitwiseAND(F.lit(1)) == 0
        parent = F.when(left, F.concat(acc["h"], s)).otherwise(F.concat(s, acc["h"]))
        return F.struct(F.sha2(parent.cast("binary"), 256).alias("h"), F.shiftright(acc["at"], 1).alias("at"))

    return F.aggregate(siblings, start, step, lambda acc: acc["h"])


def manifest(rows: DataFrame, columns: Sequence[str], group: str, order: str, altered: dict[str, Column] | None = None) -> DataFrame:
    """Merkle manifest of ``rows``: (order, leaf, subroot, root, proof, at, siblings, group_at,
    group_siblings, altered_leaf), one row for each row.

    The leaf of a row is ``record`` of ``columns``; every ``group`` has a tree over its leaves in
    ascending ``order``; the groups' roots, in ascending order of ``group`` (bytewise, null first), have a
    tree of their own. ``siblings`` and ``group_siblings`` are what lies beside the way up, bottom up,
    an empty string where nothing does; ``proof`` is the hash of both in a row. ``altered`` replaces columns
    by other expressions; ``altered_leaf`` is the leaf with these, to be held against the manifest.
    """
    prepare(rows.sparkSession)
    cols = [F.col(c) for c in columns]
    other = [(altered or {}).get(c, F.col(c)) for c in columns]
    g = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaf, changed = record(cols), record(other)
    leaves = rows.select(g.alias("g"), F.col(order).alias("first"), leaf.alias("node"), F.struct(F.col(order).alias("key"), changed.alias("altered")).alias("row"))
    leaves = written(leaves, "merkle-leaves")  # so that sampling the order doesn't hash the texts again
    trees, tops = _trees(leaves)
    roots = tops.select(F.lit("").alias("g"), F.col("g").alias("first"), F.col("top").alias("node"), F.struct(F.col("g").alias("g")).alias("row"))
    whole = _trees(roots)[0].select(F.col("row")["g"].alias("g"), F.col("at").alias("group_at"), F.col("siblings").alias("group_siblings"), F.col("top").alias("root"))
    whole = written(whole, "merkle-roots")
    out = trees.join(F.broadcast(whole) if small_enough(whole, BROADCAST_GROUPS) else whole, "g")
    proof = F.sha2(F.concat(F.array_join("siblings", ""), F.array_join("group_siblings", "")).cast("binary"), 256)
    return out.select(
        F.col("row")["key"].alias(order),
        F.col("node").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        proof.alias("proof"),
        "at",
        "siblings",
        "group_at",
        "group_siblings",
        F.col("row")["altered"].alias("altered_leaf"),
    )


def folded_root(leaf: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of its row of a ``manifest``."""
    return fold(fold(leaf, F.col("at"), F.col("siblings")), F.col("group_at"), F.col("group_siblings"))


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def verify_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` and the root that each row gives after tampering: where 7 divides the
    CRC-32 of the decimal doc_id, n_chars is one more (a null stays). A null doc_id is not tampered with."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast(T.DecimalType(20, 0)) + F.when(hit, F.lit(1)).otherwise(F.lit(0))
    tree = manifest(docs, COLUMNS, "lang", "doc_id", {"n_chars": more.cast(T.DecimalType(21, 0))})
    tree = tree.withColumn("folded_root", folded_root(F.col("altered_leaf")))
    return tree.select("doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
