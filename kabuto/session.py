"""Session helpers.

Library code never creates a session; these are for tests, the benchmark and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Configuration a cluster job is expected to carry as well: AQE for runtime re-planning
# (partition coalescing, skew-join splitting, broadcast conversion from real sizes) and
# naive datetimes that do not depend on the session zone.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # No Python call-site capture per column function (error context only; costs driver time).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kabuto") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KABUTO_DRIVER_MEMORY", "16g"))
    )
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory; create a scratch one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is (a cluster
    session without it is an error). Only a local session without the setting (tests) gets a
    fresh folder under the system temp directory.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the checkpoint folder
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (lineage cuts are written there)")
        return current
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (lineage cuts are written there)")
        current = tempfile.mkdtemp(prefix="kabuto-ckpt-")  # local sessions (tests) only
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for tables a job writes and reads back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


class Scratch:
    """Tables that a job writes to the shared checkpoint folder and reads back (a lineage cut that
    survives lost executors), deleted when the ``with`` block ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "Scratch":
        return self

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete_path(self.spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder (nothing if it isn't there) through Hadoop's file systems. A remote
    (Connect) session can't; there the folder's owner has to."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)
