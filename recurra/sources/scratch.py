"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="recurra-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder every executor can reach, below ``spark.checkpoint.dir``.

    A machine-local folder stands in only where the session has no such
    setting *and* all its tasks run in this one process (``local`` master).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/recurra/{name}-{uuid.uuid4().hex}"
