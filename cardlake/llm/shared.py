"""Tables written to the folder that the whole cluster sees."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


@cache
def _test_folder() -> str:
    """Only for sessions on one machine that name no shared folder."""
    base = tempfile.mkdtemp(prefix="cardlake-llm-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A path nobody uses yet below ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _test_folder()
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, computed once and read from a table that outlives executors.

    Cuts the lineage and gives later plans the table's real size, by which
    they choose between broadcast and shuffle.
    """
    spark = frame.sparkSession
    path = shared_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete one folder of the shared store."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
