"""Session and scratch-storage helpers.

The library never creates its own cluster settings beyond what a job needs to be
deterministic (UTC session time zone) and adaptive (AQE).  Scratch storage for
staged tables always lives under the folder the cluster names in
``spark.checkpoint.dir``; a local fallback is created only when that setting is
unset, which is the case in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "quotemill",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory",
                                     os.environ.get("QUOTEMILL_DRIVER_MEMORY", "16g"))
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``.

    When the session has none (tests, local runs) a local folder is created and
    registered, so later calls and ``DataFrame.checkpoint`` agree on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quotemill-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root (never reused)."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
