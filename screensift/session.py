"""Session construction and the shared scratch folder.

On a cluster the session is created by the platform and ``spark.checkpoint.dir``
names a folder every executor can reach; we only read it. Tests and local runs
get a fresh temporary folder when nothing is configured.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "screensift", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults this library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("SCREENSIFT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="screensift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def checkpoint(df):
    """Eager reliable checkpoint into the shared folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
