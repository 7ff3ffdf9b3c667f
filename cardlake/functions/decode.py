"""Code decoders as native expressions.

``when`` takes its ``otherwise`` branch for a NULL condition, so a NULL code is
decoded like any code that is not listed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake import schemas as S


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def token_flag(device_pan: Column) -> Column:
    """'N' for an empty-field marker, 'Y' for anything else, NULL included."""
    return F.when(device_pan.isin(S.EMPTY_MARKERS), "N").otherwise("Y")


def token_pan(device_pan: Column) -> Column:
    """The device PAN, with every empty-field marker replaced by one spelling."""
    return F.when(device_pan.isin(S.EMPTY_MARKERS), S.EMPTY_TOKEN).otherwise(device_pan)


def currency_exponent(currency: Column) -> Column:
    """Number of minor-unit digits, as text; NULL for an unknown currency."""
    exponent = F.lit(None).cast("string")
    for code, digits in S.CURRENCY_EXPONENTS.items():
        exponent = F.when(currency == code, digits).otherwise(exponent)
    return exponent


def remote_flag(indicator: Column) -> Column:
    return _yes_no(indicator.isin(S.REMOTE_INDICATORS))


def contactless_flag(entry_mode: Column) -> Column:
    return _yes_no(entry_mode == S.CONTACTLESS_ENTRY)


def fraud_flag(reason: Column) -> Column:
    return _yes_no(reason.isin(S.FRAUD_REASONS))
