"""Session settings shared by jobs, tests and benchmarks."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def get_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with UTC time and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Merge sessions inside each task before the shuffle, for keys with many events.
        .config("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
        # Checkpoints go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only acceptable when the whole application runs on one
    machine, so without the setting anything but a local master is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[\d*, ]+\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless one is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = shared_dir(spark)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for tables a job writes and reads back."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"
