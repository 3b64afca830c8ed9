"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "freshet", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Room for the days of one reach, so that windows need not spill for each.
        .config("spark.sql.windowExec.buffer.in.memory.threshold", "32768")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured is None and current is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="freshet-"))
    elif current is None:
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder; nothing is reused or cleared."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
