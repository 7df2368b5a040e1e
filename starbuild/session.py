"""Session and shared-folder helpers.

The library never creates a session inside an operator; these helpers are
for tests, the bench and command-line use.  On a cluster the session (and
``spark.checkpoint.dir``) comes from the platform; we only fill in settings
that are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast when a side turns out small), coalesces tiny
# shuffle partitions and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starbuild") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    If the setting is unset and the session is local (tests), a fresh
    folder under the system temp dir is created and set.  Elsewhere (on a
    cluster, or in a session without a JVM context, whose cluster we cannot
    see) an unset value is an error: a machine-local folder would not survive
    the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a JVM context handle
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="starbuild-ckpt-")
    sc.setCheckpointDir(path)          # what DataFrame.checkpoint uses
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001, S110 - some sessions reject core settings at runtime
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 1024 ** 3,
                     split_bytes: int = 512 * 1024 ** 2,
                     max_partitions: int = 100_000) -> dict[str, str]:
    """Starting values for a large cluster, from the input size and cores.

    Shuffle partitions: about one per ``target_partition_bytes`` of input
    (an upper bound on shuffled bytes, since every aggregate combines
    map-side), at least two waves of the cores, at most
    ``max_partitions`` (map tasks x reduce partitions is the number of
    shuffle blocks, which must stay manageable), rounded to whole waves.
    AQE then coalesces small partitions toward the advisory size and splits
    skewed ones at runtime.
    """
    by_size = -(-input_bytes // target_partition_bytes)
    parts = min(max(2 * total_cores, by_size), max(max_partitions, 2 * total_cores))
    parts = -(-parts // total_cores) * total_cores
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
