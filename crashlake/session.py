"""Session defaults for tests, the bench and command-line runs.

Cluster jobs use the session they are given; these settings only fill in
what is unset."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "crashlake") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CRASHLAKE_DRIVER_MEMORY", "8g"))
    # catalog tables of a local run live in a fresh scratch folder, not the cwd
    builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="crashlake-wh-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def _held(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small_methods(spark: SparkSession):
    """While many expressions are worked out at once (a wide feed): generated methods
    stay within the 8,000 bytes up to which the JVM compiles them, longer ones would be
    interpreted for every row. The session's setting comes back afterwards."""
    return _held(spark, "spark.sql.codegen.hugeMethodLimit", "8000")


def shuffles_end(spark: SparkSession):
    """While a result is staged: the shuffle files of the write go as it ends, and do not
    wait on disk until the driver happens to collect its garbage. The session's setting
    comes back afterwards."""
    return _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is, and it is an
    error if it is unset: a folder of the driver's own is none that executors
    can read. Only a local session without one is given a fresh scratch folder,
    once for the context."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    known = conf_dir or spark.sparkContext.getCheckpointDir()
    if known:
        if conf_dir:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return known
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="crashlake-ckpt-"))
    return spark.sparkContext.getCheckpointDir()
