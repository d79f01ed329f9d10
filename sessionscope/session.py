"""Session construction for tests, the bench and command-line jobs.

Library functions never create a session: they take DataFrames. Only the
edges (tests, ``bench.py``, ``plans.job.main``) build one here.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings results or plans depend on: tests and cluster jobs share them.
_SHARED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
_DEFAULTS = {
    **_SHARED,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Local runs see tiny shuffles; without this AQE merges them into one
    # partition (1 MB minimum) and the stage after a shuffle runs on a single
    # core. On cluster-sized data the advisory partition size governs.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # no Python call-site capture on every DataFrame call (error context only)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "sessionscope", conf: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cores]`` session configured like our cluster jobs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or cores))
    builder = builder.config("spark.driver.memory", os.environ.get("SESSIONSCOPE_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def job_session(app: str, hive: bool = False) -> SparkSession:
    """The session of a cluster job: what the cluster sets explicitly wins,
    the shared settings fill the rest."""
    builder = SparkSession.builder.appName(app)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in _SHARED.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as given; a scratch folder is chosen only for local-mode runs and tests.
    A cluster without one is an error: a machine-local folder would not
    survive the loss of the executor that wrote it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="sessionscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured
