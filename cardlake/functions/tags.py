"""Picking values out of arrays of tagged sub-fields.

Together the two steps replace exploding an array and aggregating it back, so
a message never leaves its row: no cross product of several arrays and no
shuffle. They use plain array functions, which run as generated code; functions
taking a lambda do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_subfields(subfields: Column) -> Column:
    """Sub-fields by descending key, largest value first within a key.

    The structs must consist of key and ``field_value``, in this order.
    """
    return F.sort_array(subfields, asc=False)


def tag_value(ordered: Column, key: str, wanted: str) -> Column:
    """Largest ``field_value`` of the sub-fields whose ``key`` is ``wanted``.

    ``ordered`` comes from ``order_subfields``, so the first hit is the largest.
    NULL for a missing or empty array, and when nothing carries the key.
    """
    place = F.array_position(ordered[key], wanted)
    return F.get(ordered["field_value"], (place - 1).cast("int"))
