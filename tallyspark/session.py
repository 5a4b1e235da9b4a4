"""Session helpers: a local session for tests and benches, and the shared folder.

On a cluster the session is built by the platform; the library only reads its
settings.  Anything the jobs write next to their outputs (landing extracts,
round-trip checks) goes under the folder named by ``spark.checkpoint.dir``,
which a cluster points at shared storage.  Only when that setting is unset, as
in local tests, is a fresh local folder created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyspark",
                  driver_memory: str | None = None) -> SparkSession:
    """A local-mode session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # let AQE replace a sort-merge join by a shuffled hash join when every build-side
        # partition is measured under this size (no sort of either side)
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(largest_shuffle_bytes: int, target_partition_bytes: int = 128 * 1024 ** 2) -> dict:
    """Session settings sized for a cluster run (pass them to spark-submit as ``--conf``).

    The initial shuffle partition count is the largest expected shuffle divided
    by the target partition size, so each reducer's partition fits comfortably
    in executor memory; AQE then coalesces small partitions and splits skewed
    ones at run time.  Example: a 6 TB stage-one shuffle gives ~49k partitions.
    """
    partitions = max(1, -(-int(largest_shuffle_bytes) // int(target_partition_bytes)))
    mb = f"{int(target_partition_bytes) // (1024 ** 2)}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": mb,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": mb,
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``).

    Reads the setting from the session; sets a fresh local folder only when it
    is unset (local tests), so a cluster's shared folder is never overridden.  On
    any other master the setting is required: a folder of the driver's machine
    would not be seen by the executors.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not root and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
        sc.setCheckpointDir(root)
    return root


def discard_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_path`` named, through the file system it lies in; others are refused."""
    if not path.startswith(os.path.join(checkpoint_root(spark), "tallyspark") + os.sep):
        raise ValueError(f"not a scratch folder: {path}")
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder for one output."""
    return os.path.join(checkpoint_root(spark), "tallyspark", name, uuid.uuid4().hex)
