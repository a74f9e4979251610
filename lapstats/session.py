"""Spark session helpers.

``get_session`` is for local runs and tests: it builds a session with the
defaults below. On a cluster the deployment builds the session; every
operator only reads settings from it (``spark.checkpoint.dir`` above all).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for sessions built by ``get_session``.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "lapstats",
                shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM; give it the machine's memory.
        builder = builder.config("spark.driver.memory", os.environ.get("LAPSTATS_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as-is; it is
    an error to leave it unset there. Only in local mode do we pick a scratch
    folder ourselves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lapstats-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage at a stage boundary by writing a Parquet table to the shared
    folder named by ``spark.checkpoint.dir`` and reading it back.

    Compared with ``DataFrame.checkpoint`` this computes the input once (the
    RDD checkpoint re-runs an unpersisted plan to write it), and downstream
    scans of the written table still get column pruning and filter pushdown.
    A lost executor loses nothing: the table lives on shared storage.
    """
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
