"""Column -> Column building blocks; no DataFrame, session or action here."""

from cardlake.functions.dates import (
    as_date,
    clearing_date,
    compact_date,
    date_number,
    date_parts,
    message_timestamp,
    message_year,
    month_bucket,
)
from cardlake.functions.decode import (
    contactless_flag,
    currency_exponent,
    fraud_flag,
    remote_flag,
    token_flag,
    token_pan,
)
from cardlake.functions.tags import order_subfields, tag_value
from cardlake.functions.text import (
    arn,
    bin_code,
    bin_key,
    file_name,
    integer_key,
    raw_arn,
    source_platform,
    strip,
)

__all__ = [
    "arn",
    "as_date",
    "bin_code",
    "bin_key",
    "clearing_date",
    "compact_date",
    "contactless_flag",
    "currency_exponent",
    "date_number",
    "date_parts",
    "file_name",
    "fraud_flag",
    "integer_key",
    "message_timestamp",
    "message_year",
    "month_bucket",
    "order_subfields",
    "raw_arn",
    "remote_flag",
    "source_platform",
    "strip",
    "tag_value",
    "token_flag",
    "token_pan",
]
