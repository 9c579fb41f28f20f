"""Session construction and shared-storage locations.

On a cluster the session is built by the platform; ``scratch_path`` only reads
``spark.checkpoint.dir`` from it.  A local fallback directory is created *only*
when that setting is unset (unit tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  Shuffle partitions are left to the caller on a
# cluster (size them so a post-shuffle partition is ~128-256 MB); AQE coalesces
# small ones and splits skewed join partitions at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide shared folder (``spark.checkpoint.dir``).

    Read from the session; a local temporary folder is set only where the
    setting is absent, which happens in tests and local runs.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and "
                           "all executors share")
    # Unset in a single-process session: tests and local runs.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
