"""Session settings for local runs and the shared folder used by everything that writes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str, cpus: str = "8", extra: dict[str, str] | None = None) -> SparkSession:
    """A ``local[n]`` session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CUSTODIA_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder of this machine: on a cluster the
    files would be invisible to other hosts and lost with the executor.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
    named = tempfile.mkdtemp(prefix="custodia-")
    spark.conf.set(CHECKPOINT_CONF, named)
    return named


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; snapshots never overwrite what a plan may still read."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
