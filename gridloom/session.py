"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "gridloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of its own: on a cluster a machine-local folder would
    be lost with its executor.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder before using checkpoints on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under :func:`checkpoint_root`."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
