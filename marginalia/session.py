"""Session construction for tests, the bench and local runs.

On a cluster the session comes from the platform; the operators never create
one themselves.  ``get_spark`` only sets what a local run needs and leaves the
cluster's own settings alone (``getOrCreate`` returns the existing session).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a sort-merge join into a broadcast join only after it has
    # measured the real size of the smaller side; that is the size check
    # behind every data-derived lookup in this library.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "marginalia", extra: dict | None = None) -> SparkSession:
    """Return a session; build a local one when none exists."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    active = SparkSession.getActiveSession()
    if active is not None and not (master or shuffle_partitions or extra):
        checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    conf = dict(_DEFAULTS)
    local = master or "PYSPARK_GATEWAY_PORT" not in os.environ
    if local:  # under spark-submit the cluster's master and partitions stand
        builder = builder.master(master or f"local[{cpus}]")
    if shuffle_partitions or local:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; we read it from the session
    and only fall back to a fresh scratch folder when it is unset (local runs
    and tests).
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="marginalia-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # core conf may be read-only on some deployments
            pass
    spark.sparkContext.setCheckpointDir(path)
    return path
