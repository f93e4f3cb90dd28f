"""Session factory and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "tidemark", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or in local mode one of our own where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
