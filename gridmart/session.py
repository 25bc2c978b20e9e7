"""SparkSession construction and cluster-level settings.

Settings are chosen for scale, not for the local test box:

* AQE on, with partition coalescing and skew-join splitting, so a key holding a
  large share of the rows is split at runtime instead of landing in one task.
* ``autoBroadcastJoinThreshold`` is Spark's own size check for broadcasting: a
  side is broadcast only when its estimated size at planning (10 MB, the default,
  since scans report compressed sizes) or its measured size at runtime (AQE,
  32 MB) is below the threshold; otherwise the join is shuffled.
* Session time zone pinned to UTC so year extraction is stable.
* Python call-site capture for DataFrame errors is off (plan-building speed).
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # static planning sees compressed file sizes (an estimate): stay at 10 MB;
    # AQE decides on measured shuffle output and may broadcast up to 32 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every Column call by default
    # (extra JVM round-trips per expression); plans here are built from many
    # expressions, so keep it off.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sized for the largest stage at 100 TB: the lineitem join shuffle moves about
# 600 B rows x ~32 B = ~19 TB, i.e. ~300 MB per partition at 65536 partitions.
# AQE coalesces the (many) small stages down to the advisory size; it cannot
# split an oversized non-skewed partition, so the start must be wide.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "65536",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
}


def get_spark(master: str | None = None, cores: int | None = None,
              shuffle_partitions: int | None = None, app: str = "gridmart",
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the defaults above.

    On a cluster, leave ``master`` unset and let spark-submit decide; the cluster
    settings apply when the effective master is not local.  For local runs pass
    ``master="local[8]"`` or ``cores``; shuffle partitions then default to the
    core count.  An already running session is returned unchanged.
    """
    active = SparkSession.getActiveSession()
    if active is not None and master is None and cores is None and not extra:
        return active                      # never reconfigure a running session
    builder = SparkSession.builder.appName(app)
    if master is None and cores is not None:
        master = f"local[{cores}]"
    if master:
        builder = builder.master(master)
    effective = master or SparkConf().get("spark.master", "local[*]")
    conf = dict(DEFAULT_CONF)
    if effective.startswith("local"):
        builder = builder.config("spark.driver.memory", "16g")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores or os.cpu_count() or 8)
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    else:
        # Cluster: start wide (a 100 TB join shuffle needs thousands of
        # partitions) and let AQE coalesce small stages toward the advisory size.
        conf.update(CLUSTER_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    The cluster names it in ``spark.checkpoint.dir``; that setting is read from the
    session and always wins.  Only when it is unset in local mode (tests) a
    private scratch folder is created; on a cluster an unset value is an error,
    never a machine-local fallback.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="gridmart-ckpt-")
        sc.setCheckpointDir(configured)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
