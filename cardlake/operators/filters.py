"""Row filters.

All of them test stored columns against constants, so they reach the ORC or
Parquet reader; none tests a decoded value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake import schemas as S


def _first_usage(codes: list[str]) -> Column:
    return (F.col("l00045") == S.FIRST_USAGE) & F.col("l00016").isin(codes)


def keep_presentments(feed: DataFrame) -> DataFrame:
    """First presentments of tokenised transactions, without header lines.

    A row without ``day`` goes as well: NULL is not known to differ from the
    header text.
    """
    return feed.where(
        (F.col("day").cast("string") != S.HEADER_DAY)
        & _first_usage(S.PRESENTMENT_CODES)
        & F.col("l00255").isNotNull()
        & F.col("l00196").isNotNull()
    )


def keep_chargebacks(feed: DataFrame) -> DataFrame:
    return feed.where(_first_usage(S.CHARGEBACK_CODES))


def stored_presentments(clearing: DataFrame, since: str | None = None) -> DataFrame:
    """Presentments out of a clearing table, optionally from a date on."""
    kept = clearing.where(F.col("message_type_identifier") == S.PRESENTMENT_TYPE)
    return kept if since is None else kept.where(F.col("transaction_date") >= since)


def stored_fraud_chargebacks(clearing: DataFrame) -> DataFrame:
    """Fraud chargebacks of tokenised transactions out of a clearing table."""
    return clearing.where(
        (F.col("message_type_identifier") == S.CHARGEBACK_TYPE)
        & (F.col("fraud_flag") == "Y")
        & (F.col("mdes_flag") == "Y")
    )


def _month_ranges(month: str) -> list[tuple[str, str]]:
    """Half-open ranges of text that hold every spelling of a date in one month.

    A date may be written without leading zeros, without its day, or as a bare year,
    which is its January, and blanks or control characters may follow. ``:`` is the
    character after the digits, and those before them include blanks and ``-``.
    """
    year, number = month[:4], int(month[4:])

    def upto(prefix: str) -> str:
        return prefix[:-1] + chr(ord(prefix[-1]) + 1)

    full = f"{year}-{number:02d}"
    ranges = [(full, upto(full))]
    if number < 10:
        short = f"{year}-{number}"
        ranges += [(short, short + "0"), (short + ":", upto(short))]
    if number == 1:
        ranges += [(year, year + "-"), (year + ":", upto(year))]
    return ranges


def in_months(date: Column, months: Sequence[str | None]) -> Column:
    """Whether the text ``date`` lies in one of the months, ``yyyyMM``.

    Decided by the date itself; ranges of text, which a reader can compare with
    its statistics or partitions, come first. Texts that do not start with a digit from 1 on
    are read in any case, as blanks, signs and zeros may precede a year. None stands for
    text that is no date, which no range tells apart: with it, nothing is ruled out unread.
    """
    named = sorted({m for m in months if m is not None})
    exact = fn.month_bucket(date).isin(named) if named else F.lit(False)
    if None in months:
        return exact | fn.month_bucket(date).isNull()
    ranges = [r for m in named if len(m) == 6 and m.isdigit() for r in _month_ranges(m)]
    spans = [(date >= low) & (date < high) for low, high in ranges]
    return reduce(lambda a, b: a | b, [(date < "1") | (date >= ":"), *spans]) & exact
