"""Joins with the look-up tables of the card business."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake import schemas as S
from cardlake.operators.joins import BROADCAST_LIMIT, lookup_join, surely_within

# Columns that tell clearing rows apart, for spreading a dominant key.
_FEED_SPREAD = ["l00019", "l00027", "l00328"]
_STORED_SPREAD = S.MATCH_KEYS

NATIVE_GROUP = "visa_mc_group_code"
ALTERNATE_GROUP = "mastercard_mc_group_code"


def in_merchant_group(
    categories: DataFrame, groups: DataFrame, by: str, circuit: str = S.CIRCUIT
) -> DataFrame:
    """Rows whose category group, read from column ``by``, belongs to ``circuit``."""
    own = groups.where(F.col("circuit") == circuit)
    own = own.select(F.col("mc_group_code").alias("_group"))
    return lookup_join(categories, F.col(by), own, F.col("_group")).drop("_group")


def with_merchant_category(
    feed: DataFrame,
    categories: DataFrame,
    groups: DataFrame,
    by: str,
    circuit: str = S.CIRCUIT,
) -> DataFrame:
    """Adds group code and description of the merchant category ``l00040``."""
    wanted = categories.select(
        "mc_code", *sorted({by, ALTERNATE_GROUP}), "mc_description"
    )
    joined = lookup_join(
        feed, F.col("l00040"), wanted, F.col("mc_code"), spread=_FEED_SPREAD
    )
    return in_merchant_group(joined, groups, by, circuit)


def with_known_issuer(feed: DataFrame, issuers: DataFrame) -> DataFrame:
    """Rows whose issuer ``l00004`` is registered."""
    known = issuers.select(F.col("issuer_code").alias("_issuer"))
    joined = lookup_join(
        feed, F.col("l00004"), known, F.col("_issuer"), spread=_FEED_SPREAD
    )
    return joined.drop("_issuer")


def with_card_type(feed: DataFrame, bins: DataFrame) -> DataFrame:
    """Adds ``c_tp_addbt``, found by the first eight digits of the PAN."""
    wanted = bins.select("c_pan_visa", "c_tp_addbt")
    joined = lookup_join(
        feed,
        fn.bin_key(F.col("l00019")),
        wanted,
        fn.integer_key(F.col("c_pan_visa")),
        spread=_FEED_SPREAD,
    )
    return joined.drop("c_pan_visa")


def in_report_group(
    issuers: DataFrame, report_groups: DataFrame, report_id: str = S.REPORT_ID
) -> DataFrame:
    """Rows whose ``group_code`` takes part in a report."""
    members = report_groups.where(F.col("id") == report_id)
    members = members.select(F.col("group_code").alias("_member"))
    joined = lookup_join(issuers, F.col("group_code"), members, F.col("_member"))
    return joined.drop("_member")


def with_reporting_issuer(
    presentments: DataFrame,
    issuers: DataFrame,
    report_groups: DataFrame,
    report_id: str = S.REPORT_ID,
) -> DataFrame:
    """Adds ``issuer_name`` to the presentments of a report's issuers."""
    named = issuers.select(
        F.col("issuer_code").alias("_issuer"), "issuer_name", "group_code"
    )
    joined = lookup_join(
        presentments,
        F.col("issuer_code"),
        named,
        F.col("_issuer"),
        spread=_STORED_SPREAD,
    )
    members = in_report_group(joined, report_groups, report_id)
    return members.drop("_issuer", "group_code")


# Bins go round after so many months: a longer period has a row for each of them, no more.
_MONTH_BINS = 240
_ODD_BIN = -1


def _month_number(date: Column) -> Column:
    """Months since year 0 of a stored date; NULL for text of another shape.

    It never falls as the text grows: months over 12 or under 1 count as the nearest.
    """
    month = F.substring(date, 1, 7)
    year = F.substring(month, 1, 4).try_cast("int")
    of_year = F.least(F.greatest(F.substring(month, 6, 2).try_cast("int"), F.lit(1)), F.lit(12))
    return F.when(month.rlike(r"^\d{4}-\d{2}$"), year * 12 + of_year - 1)


def in_month_bins(
    presentments: DataFrame, periods: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Presentments with a bin of their month, periods with a row per bin they touch.

    The column is ``_bin``. Months far apart share a bin, so a period without end has few
    rows and nothing has to be known of the presentments first. Dates of odd shape have a bin
    of their own, in which every period has a row; a period with an end of odd shape has one
    in all bins. A date has one bin, so a pair meets once at most.
    """
    number = _month_number(F.col("transaction_date"))
    bins = F.coalesce(number % _MONTH_BINS, F.lit(_ODD_BIN))
    binned = presentments.withColumn("_bin", bins)
    first, last = F.col("_first"), F.col("_last")
    months = F.sequence(first, F.least(last, first + (_MONTH_BINS - 1)))
    touched = (
        F.when(first.isNull() | last.isNull(), F.sequence(F.lit(0), F.lit(_MONTH_BINS - 1)))
        .when(first <= last, F.transform(months, lambda m: m % _MONTH_BINS))
    )
    rows = (
        periods.where(F.col("_start") <= F.col("_end"))
        .withColumns(
            {"_first": _month_number(F.col("_start")), "_last": _month_number(F.col("_end"))}
        )
        .withColumn("_bin", F.explode(F.concat(F.array(F.lit(_ODD_BIN)), touched)))
        .drop("_first", "_last")
    )
    return binned, rows


def within_validity(
    presentments: DataFrame, periods: DataFrame, *, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """One row per validity period of the issuer that contains the transaction date.

    Both ends belong to a period; overlapping periods repeat the row. Dates
    compare as ``yyyy-MM-dd`` text, the way they are stored. The optimizer
    moves the range test into the join. Periods beyond ``limit`` bytes are not
    broadcast but joined by issuer and month: the rows of one large issuer
    spread over the months, and meet only periods of theirs.
    """
    own = periods.select(
        F.col("issuer_code").alias("_issuer"),
        F.col("start_attivation").cast("string").alias("_start"),
        F.col("end_attivation").cast("string").alias("_end"),
    )
    if surely_within(own, limit):
        joined = lookup_join(
            presentments, F.col("issuer_code"), own, F.col("_issuer"), limit=limit
        )
    else:
        binned, rows = in_month_bins(presentments, own)
        same = (F.col("issuer_code") == F.col("_issuer")) & (binned["_bin"] == rows["_bin"])
        joined = binned.join(rows, same).drop("_bin")
    inside = F.col("transaction_date").between(F.col("_start"), F.col("_end"))
    return joined.where(inside).drop("_issuer", "_start", "_end")


def with_wallet(
    frame: DataFrame, wallets: DataFrame, wallet_name: str = S.WALLET_NAME
) -> DataFrame:
    """Adds ``token_requestor_name`` to the rows of one wallet."""
    own = wallets.where(F.col("token_requestor_name") == wallet_name).select(
        F.col("token_requestor_id").cast("bigint").alias("_wallet"),
        "token_requestor_name",
    )
    requestor = F.col("token_requestor_id").try_cast("bigint")
    joined = lookup_join(frame, requestor, own, F.col("_wallet"))
    return joined.drop("_wallet")
