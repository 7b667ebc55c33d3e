"""Spark session helpers: local session for tests/bench and the shared scratch
folder (taken from ``spark.checkpoint.dir``; set only where it is unset)."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "learnscope") -> SparkSession:
    """Local session used by tests and bench. A cluster job should use the
    session its launcher provides instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEARNSCOPE_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a single-machine ``local`` master may go without that setting (a
    folder is then made for the session); elsewhere executors would not see
    each other's files, so a missing setting raises."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not folder:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="learnscope-ckpt-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, folder)
    sc.setCheckpointDir(folder)  # makes a subfolder of its own, so this is done once
    return sc.getCheckpointDir() or folder


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that a query wrote under the shared folder."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/learnscope-scratch/{name}-{uuid.uuid4().hex[:12]}"
