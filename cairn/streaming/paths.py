"""Where streams may write: the shared checkpoint folder, a temporary one only where none is named and Spark is local."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, what: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="cairn-stream-")
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"
