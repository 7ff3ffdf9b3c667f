"""Text assembly: blank stripping, ARNs, BINs, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake import schemas as S

# Every character Unicode calls white space; the last one is U+3000.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    """Text without leading and trailing white space; '' for NULL.

    ``btrim`` with an explicit character set stays in generated code, which a
    regular expression would not, and plain ``trim`` removes spaces only.
    """
    return F.coalesce(F.btrim(text, F.lit(BLANKS)), F.lit(""))


def raw_arn() -> Column:
    """Acquirer reference number as delivered; NULL when any part is."""
    return F.concat(*S.ARN_PARTS)


def arn() -> Column:
    return strip(raw_arn())


def integer_key(text: Column) -> Column:
    """A numeric join key; text that is no number becomes NULL, not an error."""
    return text.try_cast("bigint")


def bin_key(pan: Column) -> Column:
    """The eight-digit BIN of a PAN; short PANs are filled up with zeros."""
    return integer_key(F.substring(F.rpad(pan, 19, "0"), 1, 8))


def bin_code(pan: Column) -> Column:
    return F.substring(pan, 1, 6)


def source_platform(circuit: Column) -> Column:
    return F.substring(circuit, 1, 2)


def file_name(circuit: Column, stamp: Column, ticket: Column) -> Column:
    return F.concat(circuit, stamp, ticket)
