"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Needed for right results, so they are set on every session that runs a plan.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Run-time re-planning: coalesce small shuffle partitions, split hot ones.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results and skew handling depend on to a given session."""
    for key, value in {**SEMANTIC_CONF, **ADAPTIVE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "20g", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster use the given one."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "tidemark-wh"))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, least: int = 8) -> int:
    """How many shuffle partitions keep each near ``target_bytes`` (AQE merges the surplus)."""
    return max(least, -(-input_bytes // target_bytes))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where driver and executors are one
    process; on a cluster a missing setting is an error, since executors could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
