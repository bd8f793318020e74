"""A new folder for data that a query writes only to read it back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """Below the shared folder of ``spark.checkpoint.dir``; a local session may do without."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return f"{shared.rstrip('/')}/shardloom-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
