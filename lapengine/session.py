"""SparkSession settings shared by tests, bench and the driver entry.

Library functions never create sessions; they take DataFrames.  This module
only provides a builder for local runs and a checkpoint-directory helper that
respects whatever the cluster already configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should have: UTC, AQE with skew-join splitting and
# runtime broadcast decisions based on measured (not estimated) sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE re-plans a sort-merge join as broadcast only when the measured
    # shuffle output of one side is under this bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot never compiles methods above 8,000 bytes of bytecode (the default here is 65,535): a stage whose
    # generated code is longer runs operator by operator instead, whose code Spark splits into short methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # checkpoint files go when their frame is garbage
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Local single-JVM runs (tests, bench): shuffles are a few MB, so let AQE keep
# enough partitions to use every core for the CPU-heavy window chains.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
}

# Starting point for a large cluster (~100 TB input, ~1000 executors): about
# 128-256 MB per shuffle partition before AQE coalescing, skew splitting on.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
}


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "lapengine", extra: dict | None = None) -> SparkSession:
    """Session with the engine's settings; local masters get the small-shuffle profile,
    anything else the cluster profile."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if master.startswith("local"):
        conf.update(LOCAL_CONF)
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        conf.setdefault("spark.driver.memory", "16g")
    else:
        conf.update(CLUSTER_CONF)
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def limit_method_size(spark: SparkSession) -> None:
    """``BASE_CONF``'s method limit for a session that somebody else made, unless its own is lower."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(BASE_CONF[key]):
        spark.conf.set(key, BASE_CONF[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: the one already set, else ``spark.checkpoint.dir``.

    On a cluster it must be a path that all executors share (HDFS / object
    store).  Where none is configured, a temporary folder is made if the master
    is this one process; any other master raises.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf key absent
            configured = None
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lapengine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
