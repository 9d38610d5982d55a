"""Session helpers: building a local session for tests/bench and locating the shared scratch folder.

On a cluster the session comes from the platform; the library only *reads* ``spark.checkpoint.dir`` (or the
SparkContext checkpoint directory) to know where it may write intermediate tables.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[8]", shuffle_partitions: int = 8, app: str = "upkeep", extra: dict[str, str] | None = None
) -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the SparkContext from ``spark.checkpoint.dir``.

    A private folder under the system temp dir is created only for a local master that names none (tests); on a cluster
    a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder: a machine-local one is not seen by executors")
        configured = tempfile.mkdtemp(prefix="upkeep-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared folder named by the session (for written intermediate tables)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base, "upkeep", *parts)
