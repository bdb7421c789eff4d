"""Session construction and shared-storage helpers.

On a cluster the scratch and checkpoint location is the shared folder named
by ``spark.checkpoint.dir``; it is read from the session and only set here
when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "driftwood",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the running context or ``spark.checkpoint.dir``; only when
    neither is set (a local test) a temporary folder is created and
    registered, so ``DataFrame.checkpoint`` works everywhere.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # the context appends a per-application sub folder; use its parent
        return current.rsplit("/", 1)[0] if "/" in current else current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="driftwood-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = shared_dir(spark)
    return f"{base.rstrip('/')}/driftwood-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local one)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20,
               broadcast_bytes: int = 64 << 20) -> dict:
    """Session settings sized for an input of ``input_bytes``.

    Scan splits and shuffle partitions of about ``partition_bytes`` each so
    a task's data fits executor memory without spilling; AQE coalesces small
    shuffle partitions back and splits skewed ones (a key holding a large
    share of the rows is cut into several tasks).  Broadcasts stay below
    ``broadcast_bytes`` when Spark decides on its own; the operators add
    their own row-bounded broadcasts on top.
    """
    shuffle = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_conf(spark: SparkSession, conf: dict) -> None:
    """Set runtime SQL settings on a running session."""
    for key, value in conf.items():
        spark.conf.set(key, value)
