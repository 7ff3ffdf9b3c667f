"""Where queries that exercise a sink put their tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession


@cache
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="cardlake-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody uses yet, in the folder the cluster shares.

    Only a session that names no such folder, as in tests, gets a local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"
