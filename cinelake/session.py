"""Session and workspace helpers.

Only two things are decided here: the session settings the engine relies on
(UTC session time zone, AQE) and where lineage-cutting writes go.  Shared
writes always land under ``spark.checkpoint.dir`` as configured on the
cluster; a private temporary folder is created only when the setting is
missing *and* the master is local (tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed values the engine relies on.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # bronze VARIANT columns are written shredded, so JSON paths become Parquet columns that
    # the scan can prune (Spark 4.1 defaults, pinned here)
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    # the state of streams (waiting pages) lives outside the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "cinelake",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CINELAKE_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def scale_settings(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` on ``cores`` task slots.

    * initial shuffle partitions: one per ``partition_bytes`` of input, at
      least 2 waves of the cluster, at most 100,000 (AQE coalesces small
      ones at run time, so erring high only costs scheduling);
    * scan splits of at most ``partition_bytes`` so a task's input fits in
      its share of executor memory;
    * AQE target size and skew threshold derived from the same number, so a
      partition above 4x the target is split (a key with a third of the rows
      is spread over many tasks in joins; aggregates pre-combine anyway).
    """
    n = min(100_000, max(2 * cores, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Set every session setting the engine relies on, also on a session that the caller built."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; set to a private temp folder only when unset and
    running in local mode (tests).  On a cluster an unset value is an error:
    a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):  # local-cluster is a cluster
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            d = tempfile.mkdtemp(prefix="cinelake-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


_made: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/cinelake/{purpose}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process made; returns their number.

    Results read from them lazily, so call it when no result is in use any more."""
    n = 0
    while _made:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        n += bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
    return n
