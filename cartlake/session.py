"""Session helpers: building a session for local runs and finding shared scratch space.

On a cluster the session comes from ``spark-submit``; nothing here overrides
settings the cluster already provides.  ``workspace`` resolves the shared folder
named by ``spark.checkpoint.dir`` and only invents one when it is unset (tests,
laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on.  AQE gives runtime join selection (broadcast
# only from measured sizes), skew-join splitting and partition coalescing.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def _default_driver_memory() -> str:
    """Local mode runs everything in the driver JVM: 60% of physical memory,
    between 2 and 16 GiB."""
    try:
        with open("/proc/meminfo") as f:
            kib = next(int(line.split()[1]) for line in f if line.startswith("MemTotal:"))
        gib = int(kib * 0.6 / (1024 * 1024))
    except (OSError, StopIteration, ValueError):
        gib = 4
    return f"{max(2, min(16, gib))}g"


def build_session(master: str = "local[8]", app_name: str = "cartlake",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.  Clusters pass their own conf."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CARTLAKE_DRIVER_MEMORY", _default_driver_memory())
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a private one only when none is configured
    and the session runs in local mode.  A cluster session without
    ``spark.checkpoint.dir`` is an error: a machine-local folder would not be
    visible to the other executors."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="cartlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint root for written intermediate tables."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        root = ensure_checkpoint_dir(spark)
    root = root.rstrip("/")
    return f"{root}/cartlake/{purpose}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    * Scans split files at ``target_partition_bytes``.
    * Shuffle partitions: one per 2 x ``target_partition_bytes`` of input
      (projection and map-side combining shrink what is shuffled), 200 at least.
      AQE coalesces small partitions towards the advisory size, and a
      partition five times the median and over 1 GiB is split as skewed.
    * Broadcasts stay at Spark's measured 10 MiB default: AQE only broadcasts a
      side whose runtime size is known.
    """
    partitions = max(200, -(-int(input_bytes) // (2 * target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    }


def hadoop_path(spark: SparkSession, path: str):
    """(Path, FileSystem) for ``path`` through the session's Hadoop configuration, so
    the same code works on local disks, HDFS and object stores."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a scratch folder recursively (best effort); True when it is gone."""
    try:
        p, fs = hadoop_path(spark, path)
        return fs.delete(p, True) or not fs.exists(p)
    except Exception:  # scratch cleanup must never fail a job
        return False
