"""ORC sinks. A target holding a slash is a path, any other a catalog table."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from contextlib import contextmanager, nullcontext
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from cardlake.operators.joins import stored_bytes
from cardlake.sources import table_files

# How a partition of NULLs is named, in the file layout of Hive.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# Partition values that a task writes side by side; beyond, it sorts its rows by them.
_FILES_AT_ONCE = 8

# Stored bytes below a frame for each bucket of it, packed as they are.
BUCKET_BYTES = 16 * 1024 * 1024
# The same for each range that a task sorts and writes.
RANGE_BYTES = 4 * 1024 * 1024


def laid_out(
    frame: DataFrame, partition: Sequence[str] = (), sort: Sequence[str] = ()
) -> DataFrame:
    """Rows gathered by partition value and sorted inside each task.

    The rebalance hint, not a plain repartition, gathers them: adaptive
    execution merges small partition values into few files and cuts a value
    that holds a large share of the rows into several tasks.
    """
    gathered = frame.hint("rebalance", *[F.col(c) for c in partition])
    order = [*partition, *[c for c in sort if c not in partition]]
    return gathered.sortWithinPartitions(*order) if order else gathered


def ranged(
    frame: DataFrame,
    partition: Sequence[str] = (),
    sort: Sequence[str] = (),
    *,
    files: int | None = None,
    spread: Sequence[str | Column] = (),
) -> DataFrame:
    """Rows dealt to tasks by ranges of partition and sort columns, sorted in each.

    Files of a partition value then follow each other in ``sort`` order instead of all
    spanning it, so a reader's statistics skip all but a few. ``spread`` columns come
    last in the ranges: they cut a value that holds a large share of the rows, whose files
    then share just that value. ``files`` is the number of ranges, by default that of
    shuffle partitions, which adaptive execution merges where they are small.
    """
    order = [F.col(c) for c in [*partition, *[c for c in sort if c not in partition]]]
    last = [F.col(c) if isinstance(c, str) else c for c in spread]
    dealt = (
        frame.repartitionByRange(*order, *last)
        if files is None
        else frame.repartitionByRange(files, *order, *last)
    )
    return dealt.sortWithinPartitions(*order, *last)


def _save(writer: DataFrameWriter, target: str) -> None:
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def append_partitions(
    frame: DataFrame,
    target: str,
    by: Sequence[str],
    *,
    sort: Sequence[str] = (),
    gather: bool = True,
) -> None:
    """Adds rows to a partitioned table. Running it twice adds them twice.

    ``gather=False`` skips the shuffle; right when the rows hold few partition
    values, such as one day of messages. A few are not sorted either.
    """
    rows = laid_out(frame, by, sort) if gather else frame
    with _few_open(rows.sparkSession, gather):
        _save(rows.write.mode("append").format("orc").partitionBy(*by), target)


def append(frame: DataFrame, target: str) -> None:
    """Adds rows to an unpartitioned table."""
    _save(frame.write.mode("append").format("orc"), target)


def overwrite(frame: DataFrame, target: str, *, sort: Sequence[str] = ()) -> None:
    """Replaces a whole unpartitioned table."""
    rows = frame.sortWithinPartitions(*sort) if sort else frame
    _save(rows.write.mode("overwrite").format("orc"), target)


def write_ranged(
    frame: DataFrame,
    target: str,
    by: Sequence[str],
    sort: Sequence[str],
    *,
    rows_per_file: int | None = None,
    files: int | None = None,
    spread: Sequence[str | Column] = (),
) -> None:
    """Adds rows to a partitioned table in files that do not overlap in ``sort`` order.

    No file gets more than ``rows_per_file`` rows; see ``ranged`` for the rest. There are
    more than ``files`` ranges, by a whole factor, where the files below ``frame`` hold
    more than ``RANGE_BYTES`` for each. Running it twice adds the rows twice.
    """
    if files is not None:
        files = _by_size(frame, files, RANGE_BYTES)
    rows = ranged(frame, by, sort, files=files, spread=spread)
    writer = rows.write.mode("append").format("orc").partitionBy(*by)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    _save(writer, target)


def _by_size(frame: DataFrame, least: int, each: int) -> int:
    """A multiple of ``least`` that leaves at most ``each`` stored bytes to one part."""
    return least * max(1, -(-(stored_bytes(frame) or 0) // (each * least)))


def overwrite_bucketed(
    frame: DataFrame,
    target: str,
    by: Sequence[str],
    buckets: int,
    *,
    sort: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Replaces a whole catalog table stored in buckets of ``by``, sorted in each.

    Joins and aggregates on all of ``by`` then read it without a shuffle; the other side
    is shuffled into as many buckets. Rows are gathered by bucket first, so there is one
    file a bucket. One task reads, sorts and joins a bucket, so there are more than
    ``buckets``, by a whole factor, where the files below ``frame`` hold more than
    ``BUCKET_BYTES`` for each. ``path`` keeps the files out of the warehouse. Only a
    catalog knows of buckets, so a path alone cannot be a target.
    """
    if "/" in target:
        raise ValueError(f"buckets need a catalog table, not the path {target}")
    buckets = _by_size(frame, buckets, BUCKET_BYTES)
    order = [*by, *[c for c in sort if c not in by]]
    gathered = frame.repartition(buckets, *by).sortWithinPartitions(*order)
    writer = gathered.write.mode("overwrite").format("orc").bucketBy(buckets, *by).sortBy(*order)
    (writer if path is None else writer.option("path", path)).saveAsTable(target)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _few_open(spark: SparkSession, gathered: bool):
    """While rows are written that were not gathered, a task keeps a few files open."""
    return nullcontext() if gathered else _setting(spark, _OPEN_FILES, str(_FILES_AT_ONCE))


def replace_partitions(
    frame: DataFrame, target: str, by: Sequence[str], *, sort: Sequence[str] = ()
) -> None:
    """Replaces the partitions that occur in ``frame`` and leaves the others.

    Safe to run again, but only for a frame that holds its partitions whole. For a
    catalog table the session's overwrite mode is changed while it writes, as an
    insert takes no mode of its own: overwrite no other table meanwhile.
    """
    _write_partitions(laid_out(frame, by, sort), target, by)


def _write_partitions(rows: DataFrame, target: str, by: Sequence[str]) -> None:
    if "/" in target:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .format("orc")
            .partitionBy(*by)
            .save(target)
        )
        return
    spark = rows.sparkSession
    if not spark.catalog.tableExists(target):
        _save(rows.write.format("orc").partitionBy(*by), target)
        return
    # insertInto goes by position and keeps partition columns last.
    columns = spark.table(target).columns
    with _setting(spark, _OVERWRITE_MODE, "dynamic"):
        rows.select(*columns).write.insertInto(target, overwrite=True)


def _files(spark: SparkSession, target: str, scope: Mapping[str, str]) -> set[str]:
    """Files of a table, or of the part of it that lies in ``scope``."""
    if "/" in target:
        # only that part is listed
        target = "/".join([target.rstrip("/"), *[f"{n}={v}" for n, v in scope.items()]])
        scope = {}
    parts = {f"{name}={value}" for name, value in scope.items()}
    return {f for f in table_files(spark, target) if parts <= set(f.split("/"))}


def _drop_partition(spark: SparkSession, target: str, folder: str, by: Sequence[str]) -> None:
    if "/" in target:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        place.getFileSystem(hadoop).delete(place, True)
        return
    values = [v.split("=", 1) for v in folder.split("/")[-len(by) :]]
    spec = ", ".join(
        f"`{name}` = "
        # escaped once as a file name, and once more in the URI
        + ("null" if value == _NO_VALUE else "'" + unquote(unquote(value)).replace("'", "\\'") + "'")
        for name, value in values
    )
    spark.sql(f"alter table {target} drop if exists partition ({spec})")


def replace_whole(
    frame: DataFrame,
    target: str,
    by: Sequence[str],
    *,
    scope: Mapping[str, str] | None = None,
    sort: Sequence[str] = (),
    gather: bool = True,
) -> None:
    """Makes ``frame`` all that a partitioned table holds, or all in one part of it.

    ``scope`` names the part by leading partition columns and their values, plain dates or
    names (letters, digits, ``-`` and ``_``), which are added to the rows. Safe to run again, after success or failure: new partitions are
    written aside and take the place of the old ones when all tasks are done, so a
    failed write changes nothing. Partitions in scope that ``frame`` no longer holds
    are dropped after that; a run that fails in between is mended by the next.
    """
    spark, scope = frame.sparkSession, dict(scope or {})
    for value in scope.values():
        if not re.fullmatch(r"[\w-]+", value, re.ASCII):
            raise ValueError(f"not a plain partition value: {value!r}")
    columns = [*scope, *[c for c in by if c not in scope]]
    rows = frame.withColumns({name: F.lit(value) for name, value in scope.items()})
    before = _files(spark, target, scope)
    if gather:
        rows = laid_out(rows, columns, sort)
    with _few_open(spark, gather):
        _write_partitions(rows, target, columns)
    # What was there before and still is lies in partitions that were not written.
    stale = before & _files(spark, target, scope)
    for folder in sorted({f.rsplit("/", 1)[0] for f in stale}):
        _drop_partition(spark, target, folder, columns)
    if "/" not in target:
        spark.catalog.refreshTable(target)
