"""Session-level settings shared by operators and jobs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows and bytes above which a dimension side is no longer broadcast; the join then
# falls back to a shuffle join (AQE splits skewed partitions).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset and the master is local
    (tests) create one."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if conf:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="aerocorr-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/aerocorr/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "aerocorr") -> SparkSession:
    """Session used by tests and the bench: UI off, AQE on, UTC."""
    # local runs: one shuffle partition per core (the shuffles here are
    # post-aggregation and small); clusters size them with cluster_conf()
    parts = shuffle_partitions or int(os.environ.get("AEROCORR_SHUFFLE_PARTITIONS", 0)) or (
        int(cores) if str(cores).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("AEROCORR_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, *, split_bytes: int = 512 << 20,
                 advisory_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input.

    * scan splits of ``split_bytes`` keep the task count of a 100 TB scan near
      200k instead of 800k (less scheduling, same parallelism);
    * the shuffle starts with enough partitions that none exceeds
      ``advisory_bytes`` even if a shuffle carried the whole input, and at
      least 3 per core; AQE then coalesces the (small, post-aggregation)
      shuffles of this library to the advisory size and splits skewed ones.
    """
    splits = max(1, -(-input_bytes // split_bytes))
    shuffle = max(3 * total_cores, -(-input_bytes // advisory_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "_expected_scan_tasks": str(splits),
    }
