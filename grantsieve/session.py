"""Session helpers."""

from __future__ import annotations

import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", app: str = "grantsieve") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # call sites per column cost more than building the plans themselves
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New path below the folder the cluster names for shared intermediate data.

    A local session without that setting, as in tests, gets a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return str(Path(tempfile.mkdtemp(prefix=f"{purpose}-")) / "data")
