"""Helpers shared by the operators: worker imports, lineage cuts, connected components."""

from __future__ import annotations

import gc
import os
import time

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kabuto.session import ensure_checkpoint_dir, scratch_path


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (needed when the
    package is on the driver's ``sys.path`` only) and resolve the checkpoint folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH"), root) if x)
    ensure_checkpoint_dir(spark)
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back: a lineage cut
    that survives the loss of executors (for tables that are read more than once)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing reads any more, and let go of the shuffle files of
    finished steps (Spark deletes these when the driver's JVM has collected what refers to them)."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()


IDLE_SECONDS = 10
_kept: dict[str, list] = {}


def kept(operator: str) -> dict:
    """What ``operator`` keeps in a Python worker from batch to batch. Workers go on to the steps that follow, so
    what other operators have not asked for in the last ``IDLE_SECONDS`` is let go of. An operator that keeps
    nothing itself calls it too, when a task begins: else it runs beside what those before it kept."""
    now = time.monotonic()
    idle = [k for k, (used, _) in _kept.items() if k != operator and now - used > IDLE_SECONDS]
    for other in idle:
        del _kept[other]
    if idle:
        pa.default_memory_pool().release_unused()
    mine = _kept.setdefault(operator, [now, {}])
    mine[0] = now
    return mine[1]


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows. Counts are summed per task, so no rows move."""
    return df.count() <= max_rows


BROADCAST_ROWS = 200_000  # row ids to leave out: up to so many are broadcast, more are shuffled


def row_id(id_col: str = "doc_id", text_col: str = "text"):
    """What tells the rows of a table of texts apart: the id with the text's MD5 (rows that agree in
    both are copies of one row)."""
    return F.struct(F.col(id_col).alias("id"), F.md5(F.col(text_col).cast("binary")).alias("md5"))


def without_rows(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose ``row_id`` is in the one column of ``ids`` (nulls match
    nulls). All columns stay as they are."""
    out = ids.columns[0]
    gone = ids.select(F.col(out)["id"].alias("__id"), F.col(out)["md5"].alias("__md5")).distinct()
    gone = F.broadcast(gone) if small_enough(gone, BROADCAST_ROWS) else gone
    mine = row_id(id_col, text_col)
    return docs.join(gone, mine["id"].eqNullSafe(gone["__id"]) & mine["md5"].eqNullSafe(gone["__md5"]), "left_anti")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected graph ``edges(a, b)``: rows (node, root), one for
    every node on an edge, root the same for all nodes of a component (its smallest node).

    Contraction: in each round every node hooks to the smallest of itself and its neighbours (a
    partially aggregated minimum, so a hub costs one row per task), hooks are followed to their ends
    by doubling, and the edges between ends that differ go on. At most half of the nodes are left
    after a round; a star or a chain ends in one. Every step is cut by a checkpoint.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    nodes = e.select(F.col("a").alias("node")).union(e.select(F.col("b").alias("node"))).distinct()
    labels = nodes.select("node", F.col("node").alias("root")).checkpoint()
    e = e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    for _ in range(max_rounds):
        if e.isEmpty():
            return labels
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("p")).checkpoint()
        while True:  # to the root of every tree of hooks: each turn doubles how far a node sees
            up = hook.select(F.col("u").alias("v"), F.col("p").alias("pp"))
            far = hook.join(up, hook["p"] == up["v"]).select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")).checkpoint()
            hook = far.select("u", "p")
            if far.where("moved").isEmpty():
                break
        ha = hook.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        hb = hook.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        e = (
            e.join(ha, "a")
            .join(hb, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
            .checkpoint()
        )
        up = hook.select(F.col("u").alias("root"), "p")
        labels = labels.join(up, "root", "left").select("node", F.coalesce("p", "root").alias("root")).checkpoint()
    raise RuntimeError("connected components did not converge")
