"""Session used by the tests and the benchmark, and the shared folder of a session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", memory: str = "8g", app: str = "jobledger") -> SparkSession:
    """A local session. On a cluster the caller brings its own; no operator needs a setting from here."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Where the setting is empty (tests, a laptop) the checkpoint folder of the context is used, and
    set to a new one if there is none.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="jobledger-"))
        folder = context.getCheckpointDir()
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier call has used."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
