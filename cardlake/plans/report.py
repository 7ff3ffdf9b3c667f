"""The monthly fraud report, from partial totals that can be stored and added up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake import schemas as S
from cardlake.operators import aggregates, filters, keyfilter, lookups, matching

#: What partial totals are grouped by: a report group, and the day.
TOTAL_KEYS = [
    "transaction_date",
    "issuer_code",
    "bin_code",
    "issuer_name",
    "token_requestor_id",
    "token_requestor_name",
    "c_dv_rcnc",
    "p_exp_rcnc",
]
TOTAL_COLUMNS = [*TOTAL_KEYS, "n_presented", "fraud_total", "fraud_count"]
_MONTHLY = ["month_of_report", *TOTAL_KEYS[1:]]


def _in_report(
    presented: DataFrame,
    issuers: DataFrame,
    report_groups: DataFrame,
    periods: DataFrame,
    wallets: DataFrame,
    report_id: str,
    wallet_name: str,
) -> DataFrame:
    """Presentments of the report's issuers, periods and wallet."""
    rows = filters.stored_presentments(presented).select(*S.REPORT_PRESENTMENT_COLUMNS)
    rows = lookups.with_wallet(rows, wallets, wallet_name)
    rows = lookups.with_reporting_issuer(rows, issuers, report_groups, report_id)
    return lookups.within_validity(rows, periods)


def _totals(counted: DataFrame, presented: Column) -> DataFrame:
    """Partial totals of presentments counted with their fraud counts."""
    hits = F.col("n_presented") * F.col("fraud_count")
    # No match adds nothing; a match with an unreadable amount is left out of
    # the sum, and a group of only those has no amount.
    value = F.when(F.col("fraud_count").isNull(), 0.0).otherwise(
        hits * aggregates.amount(F.col("v_rcnc"))
    )
    return counted.select(
        *TOTAL_KEYS,
        presented.alias("n_presented"),
        value.alias("fraud_total"),
        F.coalesce(hits, F.lit(0)).alias("fraud_count"),
    )


def fraud_totals(
    presented: DataFrame,
    charged_back: DataFrame,
    issuers: DataFrame,
    report_groups: DataFrame,
    periods: DataFrame,
    wallets: DataFrame,
    *,
    report_id: str = S.REPORT_ID,
    wallet_name: str = S.WALLET_NAME,
    words: int = keyfilter.WORDS,
) -> DataFrame:
    """Partial totals by day and report group; several rows of a group add up.

    Presentments are cut down to the report's issuers, periods and wallet first. Those
    that no fraud chargeback can match are added up before the one shuffle of
    presentments; see ``matching.count_fraud``.
    """
    rows = _in_report(
        presented, issuers, report_groups, periods, wallets, report_id, wallet_name
    )
    counted = matching.count_fraud(
        rows, filters.stored_fraud_chargebacks(charged_back), TOTAL_KEYS, words=words
    )
    return _totals(counted, F.col("n_presented"))


def late_totals(
    presented: DataFrame,
    new_charged_back: DataFrame,
    issuers: DataFrame,
    report_groups: DataFrame,
    periods: DataFrame,
    wallets: DataFrame,
    *,
    report_id: str = S.REPORT_ID,
    wallet_name: str = S.WALLET_NAME,
    words: int = keyfilter.WORDS,
) -> DataFrame:
    """What new chargebacks add to the totals of presentments that are already in them.

    Of ``presented`` only possible matches leave the scan: the filter comes before the
    look-ups and the shuffle. They are counted already, so ``n_presented`` is 0.
    """
    fraud = filters.stored_fraud_chargebacks(new_charged_back)
    known = keyfilter.key_filter(fraud, S.MATCH_KEYS, words)
    old = filters.stored_presentments(presented).select(
        "message_type_identifier", *S.REPORT_PRESENTMENT_COLUMNS
    )
    old = keyfilter.with_possible(old, known, S.MATCH_KEYS, "_possible", words)
    rows = _in_report(
        old.where("_possible"), issuers, report_groups, periods, wallets, report_id, wallet_name
    )
    counted = (
        rows.groupBy(*TOTAL_KEYS, *S.MATCH_KEYS)
        .agg(F.count(F.lit(1)).alias("n_presented"))
        .join(matching.fraud_counts(fraud), S.MATCH_KEYS)
    )
    return _totals(counted, F.lit(0).cast("long"))


def merged(totals: DataFrame) -> DataFrame:
    """One row for each day and group. Merging again, with more totals, changes nothing else."""
    return totals.groupBy(*TOTAL_KEYS).agg(
        *[F.sum(c).alias(c) for c in TOTAL_COLUMNS[len(TOTAL_KEYS) :]]
    )


def report_of(totals: DataFrame) -> DataFrame:
    """The report: totals by month, whose rows may be partial in any way.

    The newest date is a text, whose maximum Spark can only sort for, so totals are
    added up by day first, which hashes.
    """
    monthly = (
        merged(totals)
        .withColumn("month_of_report", fn.month_bucket(F.col("transaction_date")))
        .groupBy(*_MONTHLY)
        .agg(
            F.sum("fraud_total").alias("fraud_total"),
            F.sum("fraud_count").alias("total_transaction"),
            F.max("transaction_date").alias("last_date"),
        )
    )
    year, month, day = fn.date_parts(F.col("last_date"))
    report = monthly.withColumnsRenamed(
        {
            "issuer_name": "bin_name",
            "c_dv_rcnc": "reconciliation_currency_code",
            "p_exp_rcnc": "reconciliation_currency_code_exponents",
        }
    ).withColumns(
        {
            "reconciliation_amount": aggregates.scale(
                F.col("fraud_total"), F.col("reconciliation_currency_code_exponents")
            ),
            "year_of_last_elaboration_date": year,
            "month_of_last_elaboration_date": month,
            "day_of_last_elaboration_date": day,
        }
    )
    return report.select(*S.REPORT_COLUMNS)


def fraud_report(
    presented: DataFrame,
    charged_back: DataFrame,
    issuers: DataFrame,
    report_groups: DataFrame,
    periods: DataFrame,
    wallets: DataFrame,
    *,
    report_id: str = S.REPORT_ID,
    wallet_name: str = S.WALLET_NAME,
    months: Sequence[str | None] | None = None,
    words: int = keyfilter.WORDS,
) -> DataFrame:
    """Fraud amount and count per month, issuer, BIN, wallet and currency.

    Both message types may also come from one table, given twice. Groups without
    fraud stay, with count 0. With ``months`` (``yyyyMM``, None for unreadable dates) only
    presentments of these are read, as far as the table's layout allows.
    """
    if months is not None:
        presented = presented.where(filters.in_months(F.col("transaction_date"), months))
    totals = fraud_totals(
        presented, charged_back, issuers, report_groups, periods, wallets,
        report_id=report_id, wallet_name=wallet_name, words=words,
    )
    return report_of(totals)


def touched_months(
    presented: DataFrame, new_presented: DataFrame, new_charged_back: DataFrame
) -> DataFrame:
    """Months of the report that new rows change, one row each: ``month_of_report``.

    These are the months of the new presentments, and those of all presentments,
    ``presented``, that a new fraud chargeback matches: a chargeback counts in the
    month of its presentment, whatever its own date. NULL stands for unreadable
    dates.
    """
    month = fn.month_bucket(F.col("transaction_date")).alias("month_of_report")
    fraud = filters.stored_fraud_chargebacks(new_charged_back)
    known = keyfilter.key_filter(fraud, S.MATCH_KEYS)
    stored = filters.stored_presentments(presented)
    possible = keyfilter.with_possible(stored, known, S.MATCH_KEYS, "_possible")
    matched = possible.where("_possible").join(
        fraud.select(*S.MATCH_KEYS), S.MATCH_KEYS, "left_semi"
    )
    added = filters.stored_presentments(new_presented)
    return added.select(month).union(matched.select(month)).distinct()
