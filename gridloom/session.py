"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames.  ``local_session`` is for tests, benchmarks and examples.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every gridded job wants regardless of cluster size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "gridloom", extra_conf: dict | None = None) -> SparkSession:
    """A local session configured the way the test-suite and bench expect."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**BASE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("GRIDLOOM_DRIVER_MEM", "8g"))
               .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024)))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (shared
    storage).  Only a local-mode session (tests) may fall back to a fresh
    temporary folder; a cluster session without the setting is an error,
    since a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="gridloom-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()
