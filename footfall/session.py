"""Session helpers.

The library never builds a session for a job: every function takes DataFrames
(or a session) from the caller. ``local_session`` exists for tests, the bench
and the driver's smoke check only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "4g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured like a small cluster job (UI off, AQE on, UTC)."""
    builder = SparkSession.builder
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("footfall")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.io.compression.codec", "zstd")   # shuffles of sorted or repeated keys shrink by a third against lz4
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    Where none is set, a session of one machine (master ``local...``, as in tests) gets a scratch folder;
    on a cluster the executors could not see one, so that is an error.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="footfall-ckpt-", dir=os.environ.get("FOOTFALL_SCRATCH", "/tmp"))
    spark.conf.set(CHECKPOINT_KEY, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for tables a job writes and reads back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
