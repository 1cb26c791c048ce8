"""Session settings and the shared scratch folder.

The settings are the ones a load job wants on a large cluster: adaptive query
execution (runtime broadcast of small sides, partition coalescing, skew-join
splitting), a UTC session clock, dynamic partition overwrite handled per write,
and no web UI.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings applied to every session built here.  Values sized for a large
# cluster; tests and the bench shrink the shuffle partition count.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Shuffles start wide and AQE merges them down to the advisory size: a
    # 50 TB shuffle gets ~3 GB partitions (sorts spill, none is lost), a
    # small one is coalesced to a few tasks.  AQE can merge partitions but
    # not split them (outside skew joins), so the start must be wide.
    "spark.sql.shuffle.partitions": "16384",
    # Coalesce by the advisory size, not by the cluster's core count (which
    # would merge a huge shuffle into partitions of tens of GB).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # AQE turns a sort-merge join into a broadcast join only after it has
    # measured the small side at runtime; this is the size bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files (touched partition values, hot keys, rebuilt catalog
    # partitions) are deleted once nothing references them, so a long-running
    # stage stream does not fill the shared folder batch after batch.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.orc.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "loadwright",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS, object store), so
    a session off ``local`` without one is refused.  Only a local session
    (tests) gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="loadwright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder (reliable, lineage cut)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "loadwright", f"{name}-{uuid.uuid4().hex[:12]}")


def scratch_table_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"
