"""The four jobs as DataFrame plans, and the same jobs from table to table."""

from cardlake.plans.authorization import (
    authorization_trace,
    message_fields,
    parse_messages,
)
from cardlake.plans.clearing import chargebacks, clearing_union, presentments
from cardlake.plans.report import (
    fraud_report,
    fraud_totals,
    late_totals,
    merged,
    report_of,
    touched_months,
)

__all__ = [
    "authorization_trace",
    "chargebacks",
    "clearing_union",
    "fraud_report",
    "fraud_totals",
    "late_totals",
    "merged",
    "message_fields",
    "parse_messages",
    "presentments",
    "report_of",
    "touched_months",
]
