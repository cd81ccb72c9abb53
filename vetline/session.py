"""Session and shared-folder helpers.

Everything the library writes between steps (staged tables, table versions,
stream checkpoints) lives under one *shared* root that every executor can see.
On a cluster that root is the folder named by ``spark.checkpoint.dir``; the
library reads it from the session and only invents a local one when the
setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", app_name: str = "vetline",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session with the settings the library is tuned for.

    AQE re-plans joins and coalesces shuffle partitions at run time, and its
    skew handling splits hot partitions of the preserved side of a right join.
    The coalescing floor is lowered from 1 MB: partitioned writes cost per
    *file*, and merging small rebalanced partitions would leave a few tasks
    writing every folder (large partitions are unaffected).
    """
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.catalogImplementation", "in-memory")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    cores = _local_cores(master)
    if cores:
        # One listing task per folder (Spark's default, up to 10,000) costs more
        # than it saves on a local disk; a few per core list hundreds of
        # partition folders in one short wave.
        builder = builder.config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(8 * cores))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _local_cores(master: str) -> int | None:
    m = re.match(r"local\[(\*|\d+)", master.replace(" ", ""))
    if not m:
        return 1 if master == "local" else None
    if m.group(1) == "*":
        return os.cpu_count() or 1
    return int(m.group(1))


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 << 20,
                   listing_parallelism: int = 2_000) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes``.

    The initial shuffle partition count gives ~``target_partition_bytes`` per
    task (so shuffle blocks fit in executor memory without spilling), AQE
    coalesces small ones and splits skewed ones at run time with the same
    advisory size, and scans read splits of that size. Folder listing (partition
    discovery, file streams) runs ``listing_parallelism`` tasks: object-store
    listing is latency-bound, so a cluster wants many. Pass the result as
    ``build_session(extra=...)`` or set it on an existing session.
    """
    parts = max(200, -(-int(input_bytes) // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(listing_parallelism),
    }


def shared_root(spark: SparkSession) -> str:
    """Shared folder for intermediate output.

    Uses ``spark.checkpoint.dir`` (conf or SparkContext) when the cluster names
    one. Only a local-mode session (tests, laptops) may fall back to a local
    folder; on a cluster a machine-local folder would scatter intermediate
    files over the executors' disks, so a missing setting is an error there.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if _local_cores(spark.sparkContext.master) is None:
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach "
                           "(e.g. on the cluster's distributed file system)")
    root = tempfile.mkdtemp(prefix="vetline-")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set(_CHECKPOINT_KEY, root)
    # setCheckpointDir may add a uuid sub-folder; keep the one Spark uses.
    return (spark.sparkContext.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared root."""
    return "/".join([shared_root(spark), "vetline", *parts, uuid.uuid4().hex[:12]])


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop's FileSystem, so object stores work too."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through Hadoop's FileSystem (staging cleanup)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        return bool(fs.delete(hpath, True))
    return False


def qualify(path: str) -> str:
    """Plain local paths become ``file:`` URIs; URIs pass through."""
    if "://" in path or path.startswith("file:"):
        return path
    return "file://" + os.path.abspath(path)
