"""The jobs from stored table to stored table.

Tables are catalog names, or paths of ORC data when they hold a slash.
Presentments and chargebacks are kept in two tables, since one is rebuilt and
the other only grows; the report reads both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake import schemas as S
from cardlake.operators import keyfilter, matching
from cardlake.plans.authorization import authorization_trace
from cardlake.plans.clearing import chargebacks, presentments
from cardlake.plans.report import fraud_report, fraud_totals, late_totals, merged, report_of
from cardlake.sinks import (
    append,
    append_partitions,
    overwrite,
    overwrite_bucketed,
    ranged,
    replace_partitions,
    replace_whole,
)
from cardlake.sources import day_slice, read_table, run_day, ymd_partition


def authorization_job(
    spark: SparkSession,
    *,
    messages: str,
    target: str,
    run_date: str | None = None,
    elaboration_date: str | None = None,
    gather: bool = False,
    load_column: str | None = None,
) -> None:
    """Flattens one day of messages and stores it by message date.

    A message date can arrive on several days, so replacing its partition would
    lose rows. With ``load_column`` the table is partitioned by that column first, which
    holds the run date, and a day replaces all it has stored before: it may run twice, or
    again after a failure. Without it rows are appended, and a day must not be
    loaded twice. ``gather`` shuffles the rows by date before writing, for days that hold
    many dates.
    """
    run_date = run_day(spark, run_date)
    day = day_slice(read_table(spark, messages), "time_stamp", run_date)
    rows = authorization_trace(day, elaboration_date)
    _store_load(rows, target, ["Token_Date"], load_column, run_date, gather=gather)


def _store_load(
    rows: DataFrame,
    target: str,
    by: Sequence[str],
    load_column: str | None,
    run_date: str,
    *,
    sort: Sequence[str] = (),
    gather: bool = True,
) -> None:
    """One load, in place of what it stored before, or appended without a load column."""
    if load_column is not None:
        scope = {load_column: run_date}
        # a load without further partitions is one value, for which nothing is gathered
        replace_whole(rows, target, by, scope=scope, sort=sort, gather=gather and bool(by))
    elif by:
        append_partitions(rows, target, by, sort=sort, gather=gather)
    else:
        append(rows, target)


def _feed(
    spark: SparkSession, source: str, run_date: str | None, partitioned: bool
) -> DataFrame:
    feed = read_table(spark, source)
    return ymd_partition(feed, run_date) if partitioned else feed


def presentment_job(
    spark: SparkSession,
    *,
    feed: str,
    issuers: str,
    bins: str,
    categories: str,
    groups: str,
    target: str,
    run_date: str | None = None,
    daily: bool = False,
    load_column: str | None = None,
    by_range: bool = False,
    buckets: int | None = None,
    arn_parts: int = 1,
) -> None:
    """Rebuilds the presentment table.

    ``daily`` reads one year/month/day partition of the feed instead and adds it. The
    day is that of the import: transaction dates tell nothing about what is
    loaded, since rows come late and a December transaction imported in January
    gets the later year. With ``load_column`` a day is stored under its run date and may
    run again; without it a day must not be loaded twice.

    A rebuilt table is sorted by date inside its files. ``by_range`` deals rows to files
    by date, so readers of some dates skip the other files. ``buckets`` stores a catalog
    table in buckets of ``arn`` instead, which spares the ARN join a shuffle of it;
    ``arn_parts`` spreads a dominant ARN over as many buckets.
    """
    if daily:
        run_date = run_day(spark, run_date)
    rows = presentments(
        _feed(spark, feed, run_date, daily),
        read_table(spark, issuers),
        read_table(spark, bins),
        read_table(spark, categories),
        read_table(spark, groups),
    )
    if daily:
        _store_load(rows, target, [], load_column, run_date)
    elif buckets is not None:
        by = ["arn"]
        if arn_parts > 1:
            rows, by = matching.with_arn_part(rows, arn_parts), ["arn", matching.ARN_PART]
        overwrite_bucketed(rows, target, by, buckets)
    elif by_range:
        spread = ["arn", "trace_id"]
        overwrite(ranged(rows, sort=["transaction_date"], spread=spread), target)
    else:
        overwrite(rows, target, sort=["transaction_date"])


def chargeback_job(
    spark: SparkSession,
    *,
    feed: str,
    clearing: str,
    bins: str,
    categories: str,
    groups: str,
    target: str,
    run_date: str | None = None,
    daily: bool = False,
    since: str | None = None,
    strip_keys: bool = False,
    replace: bool = False,
    load_column: str | None = None,
    salts: int = 1,
    arn_parts: int = 1,
) -> None:
    """Matches chargebacks to presentments and stores them by transaction date.

    ``daily`` reads one year/month/day partition of the feed; with ``load_column`` the
    day is stored under its run date and may run again. ``replace`` makes a full run
    repeatable: dates that the feed no longer holds go. It needs the whole feed, as a
    transaction date may be spread over several feed days. ``arn_parts`` is that of
    the presentments.
    """
    if replace and daily:
        raise ValueError("replace needs the whole feed, not one day of it")
    if load_column is not None and not daily:
        raise ValueError("a load column is for daily runs")
    if daily:
        run_date = run_day(spark, run_date)
    rows = chargebacks(
        _feed(spark, feed, run_date, daily),
        read_table(spark, clearing, text=["transaction_date"]),
        read_table(spark, bins),
        read_table(spark, categories),
        read_table(spark, groups),
        since=since,
        strip_keys=strip_keys,
        salts=salts,
        arn_parts=arn_parts,
    )
    by, sort = ["transaction_date"], ["clearing_file_name"]
    if replace:
        replace_whole(rows, target, by, sort=sort)
    else:
        _store_load(rows, target, by, load_column, run_date or "", sort=sort)


def report_job(
    spark: SparkSession,
    *,
    presented: str,
    charged_back: str,
    issuers: str,
    report_groups: str,
    periods: str,
    wallets: str,
    target: str,
    months: Sequence[str | None] | None = None,
    report_id: str = S.REPORT_ID,
    wallet_name: str = S.WALLET_NAME,
) -> None:
    """Rebuilds the monthly report.

    With ``months`` only these (``yyyyMM``, None for unreadable dates) are computed,
    whole, and replace their partitions of a report stored by month; presentments
    stored by date or in its order are read only as far as these months reach. Name every
    month that ``touched_months`` gives for new presentments and chargebacks; late
    ones are then counted, and no group is stored twice.
    """
    report = fraud_report(
        read_table(spark, presented, text=["transaction_date"]),
        read_table(spark, charged_back, text=["transaction_date"]),
        read_table(spark, issuers),
        read_table(spark, report_groups),
        read_table(spark, periods),
        read_table(spark, wallets),
        report_id=report_id,
        wallet_name=wallet_name,
        months=months,
    )
    if months is None:
        overwrite(report, target)
    else:
        replace_partitions(report, target, ["month_of_report"])


def totals_job(
    spark: SparkSession,
    *,
    presented: str,
    charged_back: str,
    issuers: str,
    report_groups: str,
    periods: str,
    wallets: str,
    target: str,
    run_date: str,
    load_column: str,
    report_id: str = S.REPORT_ID,
    wallet_name: str = S.WALLET_NAME,
    words: int = keyfilter.WORDS,
) -> None:
    """Stores what one load adds to the report, as partial totals under its run date.

    Both clearing tables are stored by ``load_column``. New presentments are read from
    their own partition and counted with all fraud chargebacks up to this load, of
    which only keys are read; earlier presentments are looked up by the keys of the new
    chargebacks, and only possible matches leave the scan. A load may run again. Look-up
    tables are taken as they are now: after a change of theirs every load has to run again.
    """
    loads = F.col(load_column).cast("string")
    all_presented = read_table(spark, presented, text=["transaction_date", load_column])
    all_back = read_table(spark, charged_back, text=["transaction_date", load_column])
    tables = [read_table(spark, t) for t in (issuers, report_groups, periods, wallets)]
    options = {"report_id": report_id, "wallet_name": wallet_name, "words": words}
    added = fraud_totals(
        all_presented.where(loads == run_date), all_back.where(loads <= run_date),
        *tables, **options,
    )
    late = late_totals(
        all_presented.where(loads < run_date), all_back.where(loads == run_date),
        *tables, **options,
    )
    rows = merged(added.unionByName(late))
    replace_whole(rows, target, [], scope={load_column: run_date}, gather=False)


def merged_report_job(spark: SparkSession, *, totals: str, target: str) -> None:
    """Rebuilds the monthly report from stored totals alone."""
    overwrite(report_of(read_table(spark, totals)), target)
