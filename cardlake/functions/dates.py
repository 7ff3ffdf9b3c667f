"""Dates. Stored dates are text; they turn into DATE only inside expressions.

Unparsable text gives NULL everywhere, so one bad row never fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake import schemas as S


def as_date(text: Column) -> Column:
    return text.try_cast("date")


def message_year(message_id: Column) -> Column:
    """Two-digit year inside a message id; '' when the id holds no date."""
    return F.regexp_extract(message_id, S.MESSAGE_YEAR_PATTERN, 1)


def message_timestamp(year: Column, month_to_second: Column) -> Column:
    """``20YY-MM-DD hh:mm:ss.000`` from a two-digit year and ``MMDDhhmmss``.

    The century is fixed. NULL when either input is NULL.
    """
    separators = ["-", "-", " ", ":", ":"]
    pieces = [F.lit("20"), year]
    for slot, separator in enumerate(separators):
        pieces += [F.lit(separator), F.substring(month_to_second, 2 * slot + 1, 2)]
    return F.concat(*pieces, F.lit(".000"))


def clearing_date(import_timestamp: Column, month_day: Column) -> Column:
    """``yyyy-MM-dd`` text: year of the import, month and day of the transaction.

    A December transaction imported in January therefore gets the later year;
    readers of the clearing table rely on this.
    """
    return F.concat(
        F.substring(import_timestamp, 1, 5),
        F.substring(month_day, 1, 2),
        F.lit("-"),
        F.substring(month_day, 3, 2),
    )


def compact_date(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def month_bucket(text: Column) -> Column:
    return F.date_format(as_date(text), "yyyyMM")


def date_parts(text: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of month as INT."""
    day = as_date(text)
    return F.year(day), F.month(day), F.dayofmonth(day)


def date_number(year: Column, month: Column, day: Column) -> Column:
    """A date as one sortable integer, e.g. 20240131."""
    return year * 10000 + month * 100 + day
