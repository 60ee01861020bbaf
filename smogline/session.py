"""Session helpers: building a session for tests/bench and locating the
shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(a shared file system / object store path).  We only choose our own folder
when the session has none, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "smogline") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SMOGLINE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Session settings the engine relies on (idempotent)."""
    # calendar semantics must not depend on the machine's zone
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master or "").startswith("local") or (sc.master or "").startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="smogline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/smogline-{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    * scan splits of ``target_partition_bytes`` (the raw scans are the
      largest stages);
    * initial shuffle partitions so that a post-shuffle partition of the raw
      readings stays near the same size, at least 3 waves of tasks, AQE then
      coalesces the small shuffles (aggregated sensor-days, city-days);
    * skew-join splitting on, with the skew threshold at the partition size;
    * broadcast only below 64 MB of measured size.
    """
    slots = max(1, executors * cores_per_executor)
    parts = max(3 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024**2),
        "spark.sql.session.timeZone": "UTC",
    }
