"""Tables by catalog name or path, and the slices jobs take of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.operators.joins import BROADCAST_LIMIT, surely_within


def read_table(
    spark: SparkSession,
    source: str,
    columns: Sequence[str] | None = None,
    *,
    format: str = "orc",
    schema: T.StructType | None = None,
    text: Sequence[str] = (),
) -> DataFrame:
    """A catalog table (``db.name``) or, when the source holds a slash, a path.

    ``text`` names partition columns that hold text. Read by path, Spark would guess
    their type from their values, and a guessed date fails on an impossible one.
    """
    if "/" not in source:
        frame = spark.table(source)
    else:
        reader = spark.read.format(format)
        frame = (reader if schema is None else reader.schema(schema)).load(source)
        guessed = [
            c for c in text if c in frame.columns and frame.schema[c].dataType != T.StringType()
        ]
        if guessed:
            declared = T.StructType(
                [
                    T.StructField(f.name, T.StringType()) if f.name in guessed else f
                    for f in frame.schema
                ]
            )
            frame = spark.read.format(format).schema(declared).load(source)
    return frame if columns is None else frame.select(*columns)


# An empty folder has no files to take a schema from.
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_exists(spark: SparkSession, source: str) -> bool:
    """Whether a table, or a path that can be read, is there."""
    if "/" not in source:
        return spark.catalog.tableExists(source)
    try:
        read_table(spark, source)
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return False
        raise
    return True


def table_files(spark: SparkSession, source: str) -> set[str]:
    """Files of a table or path as they are now; none where nothing is there."""
    if "/" not in source:
        if not spark.catalog.tableExists(source):
            return set()
        spark.catalog.refreshTable(source)
    try:
        return set(read_table(spark, source).inputFiles())
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return set()
        raise


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)


def run_day(spark: SparkSession, run_date: str | None = None) -> str:
    """The day a job runs for, ``yyyy-MM-dd``: the one given, or yesterday."""
    if run_date is not None:
        return run_date
    return spark.range(1).select(F.date_format(yesterday(), "yyyy-MM-dd")).first()[0]


def day_slice(frame: DataFrame, column: str, run_date: str | None = None) -> DataFrame:
    """Rows of one day, yesterday by default.

    Text columns hold ``yyyy-MM-dd`` and compare equal; timestamps and dates
    fall into a half-open range. Neither form wraps the stored column, so it
    prunes partitions or row groups.
    """
    day = yesterday() if run_date is None else F.lit(run_date).cast("date")
    stored = F.col(column)
    kind = frame.schema[column].dataType
    if isinstance(kind, T.StringType):
        return frame.where(stored == F.date_format(day, "yyyy-MM-dd"))
    start, end = day.cast(kind), F.date_add(day, 1).cast(kind)
    return frame.where((stored >= start) & (stored < end))


def ymd_partition(
    frame: DataFrame,
    run_date: str | None = None,
    names: Sequence[str] = ("year", "month", "day"),
) -> DataFrame:
    """Rows of one day in a table partitioned by year, month and day."""
    day = yesterday() if run_date is None else F.lit(run_date).cast("date")
    kept = frame
    for name, pattern in zip(names, ("yyyy", "MM", "dd"), strict=True):
        part = F.date_format(day, pattern).cast(frame.schema[name].dataType)
        kept = kept.where(F.col(name) == part)
    return kept


def ymd_days(
    frame: DataFrame,
    days: DataFrame,
    column: str = "day",
    names: Sequence[str] = ("year", "month", "day"),
    *,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Rows of several days in a table partitioned by year, month and day.

    The days are the dates in ``column`` of ``days``, whatever that holds at run time;
    NULL and repeated ones add nothing. Broadcast, they choose the partitions before
    these are listed or read; Spark does so where ``days`` comes through a filter. More
    than ``limit`` bytes of days are not broadcast.
    """
    parts = [
        F.date_format(F.col(column), pattern).cast(frame.schema[name].dataType).alias(name)
        for name, pattern in zip(names, ("yyyy", "MM", "dd"), strict=True)
    ]
    wanted = days.where(F.col(column).isNotNull()).select(*parts)
    if surely_within(wanted, limit):
        wanted = F.broadcast(wanted)
    return frame.join(wanted, list(names), "left_semi")
