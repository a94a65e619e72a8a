"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

KEY = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared folder; where none is set and all tasks run on this machine, below a new temporary folder."""
    root = spark.conf.get(KEY, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {KEY} to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(KEY, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
