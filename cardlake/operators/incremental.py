"""Loading only what is newer than the target already holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import functions as fn


def high_water_mark(target: DataFrame, newest: Column) -> DataFrame:
    """One row, ``mark``: the largest date number in ``target``; 0 when it is empty."""
    return target.agg(F.coalesce(F.max(newest), F.lit(0)).alias("mark"))


def text_date_number(date: Column) -> Column:
    return fn.date_number(*fn.date_parts(date))


def newer_than(frame: DataFrame, number: Column, mark: DataFrame | None) -> DataFrame:
    """Rows whose date number is above the mark; rows without a date go.

    The mark is a scalar subquery, computed once on the executors. ``None``
    stands for a target that does not exist yet.
    """
    return frame.where(number > (F.lit(0) if mark is None else mark.scalar()))
