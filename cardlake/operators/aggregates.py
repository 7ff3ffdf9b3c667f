"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount(text: Column) -> Column:
    """A stored minor-unit amount as DOUBLE; unreadable text becomes NULL."""
    return text.try_cast("double")


def scale(total: Column, exponent: Column) -> Column:
    """Minor units to major units; NULL for an unknown exponent."""
    return total / F.pow(F.lit(10.0), exponent.try_cast("double"))
