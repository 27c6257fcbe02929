"""Where the library may write intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local session without that setting gets a
    temporary folder; on a cluster its absence is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/tidemark-{label}-{uuid.uuid4().hex}"
