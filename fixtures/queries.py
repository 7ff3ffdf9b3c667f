"""One query per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake import schemas as S
from cardlake import sinks
from cardlake.operators import aggregates, filters, incremental, lookups, matching
from cardlake.plans import authorization, clearing, jobs, report
from cardlake.sources import day_slice, read_table, ymd_days, ymd_partition
from fixtures.adapters import MESSAGES, view
from fixtures.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

MESSAGE_DAY = "1997-01-01"
EVENT_DAY = "2024-01-10"
ORDER_DAY = "1995-06-19"
MONTH_END = "1995-01-31"
REPORT_MONTHS = ["199703", "199801", "199802"]
ELABORATION_DAY = "2024-02-29"
NEWER_THAN = "1998-01-01"
ROWS_PER_FILE = 50
LOADS = ["2024-01-01", "2024-01-02"]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def order_date() -> Column:
    return F.col("o_orderdate").cast("date").cast("string")


def order_month_to_second() -> Column:
    return F.concat(F.date_format("o_orderdate", "MMdd"), F.lit("101530"))


def order_message_id() -> Column:
    dated = F.concat(F.lit("M "), F.date_format("o_orderdate", "yy-MM-dd"), F.lit(" "))
    return F.when(F.col("o_orderstatus") == "P", "M undated").otherwise(dated)


# ------------------------------------------------------------------ slices


@query
def scan_day_slice(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    day = day_slice(events, "ts", EVENT_DAY)
    return day.select("event_id", "user_id", "event_type", "value")


@query
def ymd_partition_filter(spark, sf_dir):
    date = F.col("o_orderdate")
    dated = orders(spark, sf_dir).select(
        "o_orderkey",
        "o_custkey",
        F.date_format(date, "yyyy").alias("year"),
        F.date_format(date, "MM").alias("month"),
        F.date_format(date, "dd").alias("day"),
    )
    return ymd_partition(dated, ORDER_DAY)


def _orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by year, month and day, each under the last day of its month."""
    day, path = F.last_day("o_orderdate"), scratch_path(spark, "orders")
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    dated = orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", *[F.date_format(day, f).alias(n) for n, f in parts.items()]
    )
    sinks.append_partitions(dated, path, list(parts))
    return read_table(spark, path, text=list(parts))


@query
def ymd_partition_stored(spark, sf_dir):
    return ymd_partition(_orders_by_day(spark, sf_dir), MONTH_END)


@query
def ymd_partition_dynamic(spark, sf_dir):
    """Days that another table names when the query runs."""
    region = spark.read.parquet(f"{sf_dir}/region.parquet").where("r_name <> 'ASIA'")
    months = (F.col("r_regionkey") * 7).cast("int")
    days = region.select(F.last_day(F.add_months(F.lit(MONTH_END).cast("date"), months)).alias("day"))
    return ymd_days(_orders_by_day(spark, sf_dir), days)


@query
def presentment_readback(spark, sf_dir):
    stored = filters.stored_presentments(clearing_union(spark, sf_dir))
    return stored.select(*S.REPORT_PRESENTMENT_COLUMNS)


@query
def fraud_chargeback_readback(spark, sf_dir):
    return filters.stored_fraud_chargebacks(clearing_union(spark, sf_dir))


# -------------------------------------------------------------------- JSON


@query
def json_event_fields(spark, sf_dir):
    """Fields of JSON text that Spark did not write; one that is absent is NULL."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    parsed = F.from_json("props", "k string, absent string")
    return events.select("event_id", parsed.alias("p")).select("event_id", "p.k", "p.absent")


@query
def json_parse_fields(spark, sf_dir):
    parsed = authorization.parse_messages(view(spark, sf_dir, MESSAGES), elements=S.SIMPLE_ELEMENTS)
    return parsed.select("message_id", *S.SIMPLE_ELEMENTS.values())


@query
def json_malformed(spark, sf_dir):
    parsed = authorization.parse_messages(view(spark, sf_dir, MESSAGES), elements=[37, 123])
    return parsed.select(
        "message_id",
        "Retrieval_Reference_Number",
        F.array_size("subfields_123").alias("subfields"),
    )


@query
def json_inline_outer(spark, sf_dir):
    parsed = authorization.parse_messages(view(spark, sf_dir, MESSAGES), elements=[37, 123])
    return parsed.select(
        "message_id", "Retrieval_Reference_Number", F.inline_outer("subfields_123")
    )


@query
def tag_pivot(spark, sf_dir):
    fields = authorization.message_fields(
        view(spark, sf_dir, MESSAGES), elements=[37, *S.TAGGED_ELEMENTS]
    )
    names = [n for _, tags in S.TAGGED_ELEMENTS.values() for n in tags.values()]
    return fields.select("message_id", "Retrieval_Reference_Number", *names)


@query
def auth_trace(spark, sf_dir):
    return authorization.authorization_trace(view(spark, sf_dir, MESSAGES), ELABORATION_DAY)


@query
def auth_trace_daily(spark, sf_dir):
    day = day_slice(view(spark, sf_dir, MESSAGES), "time_stamp", MESSAGE_DAY)
    return authorization.authorization_trace(day, ELABORATION_DAY)


# ------------------------------------------------------------------- dates


@query
def regex_year(spark, sf_dir):
    return orders(spark, sf_dir).select(
        "o_orderkey", fn.message_year(order_message_id()).alias("message_year")
    )


@query
def timestamp_assembly(spark, sf_dir):
    stamp = fn.message_timestamp(
        fn.message_year(order_message_id()), order_month_to_second()
    )
    stamped = orders(spark, sf_dir).select("o_orderkey", stamp.alias("token_timestamp"))
    return stamped.withColumn("token_date", F.substring("token_timestamp", 1, 10))


@query
def compact_date(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return orders(spark, sf_dir).select(
        "o_orderkey", fn.compact_date(day).alias("compact_date")
    )


@query
def month_bucket(spark, sf_dir):
    return (
        orders(spark, sf_dir)
        .groupBy(fn.month_bucket(order_date()).alias("month_of_report"))
        .agg(F.count("*").alias("orders"))
    )


@query
def date_parts(spark, sf_dir):
    year, month, day = fn.date_parts(order_date())
    return orders(spark, sf_dir).select(
        "o_orderkey", year.alias("year"), month.alias("month"), day.alias("day")
    )


# ---------------------------------------------------------------- decoders


def feed_query(columns: Callable[[], list[Column]]) -> None:
    """Registers expressions over the presentment feed, next to its line key."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = view(spark, sf_dir, "presentment_feed")
        return feed.select("l00026", "l00028", *columns())

    QUERIES[columns.__name__] = build


@feed_query
def decode_sentinel_flag():
    return [F.col("l00255"), fn.token_flag(F.col("l00255")).alias("mdes_flag")]


@feed_query
def decode_sentinel_replace():
    return [F.col("l00255"), fn.token_pan(F.col("l00255")).alias("dpan")]


@feed_query
def decode_currency_exponent():
    return [F.col("l00034"), fn.currency_exponent(F.col("l00034")).alias("p_exp_rcnc")]


@feed_query
def decode_set_flag():
    return [F.col("l00074"), fn.remote_flag(F.col("l00074")).alias("remote_trx_flag")]


@feed_query
def decode_equal_flag():
    flag = fn.contactless_flag(F.col("l00054"))
    return [F.col("l00054"), flag.alias("nfc_technology_flag")]


@feed_query
def decode_fraud_reason():
    return [F.col("l00046"), fn.fraud_flag(F.col("l00046")).alias("fraud_flag")]


@feed_query
def strip_blanks():
    return [
        fn.strip(F.col("l00019")).alias("funding_pan"),
        fn.strip(F.col("l00328")).alias("trace_id"),
        fn.strip(F.col("l00255")).alias("device_pan"),
    ]


@feed_query
def arn_concat():
    return [fn.raw_arn().alias("raw_arn"), fn.arn().alias("arn")]


@feed_query
def clearing_date_assembly():
    date = fn.clearing_date(F.col("import_timestamp"), F.col("l00032"))
    return [date.alias("transaction_date")]


@feed_query
def clearing_file_name():
    circuit, ticket = F.col("circuito"), F.col("ticket")
    return [
        fn.file_name(circuit, F.col("l00032"), ticket).alias("presentment_file"),
        fn.file_name(circuit, F.col("l00022"), ticket).alias("chargeback_file"),
    ]


@query
def typed_constant_columns(spark, sf_dir):
    return presentment(spark, sf_dir).select(
        "arn", "circuit", "message_type_identifier", "fraud_flag", "c_activity",
        "token_requestor_id", "abi_code", "merchant_address",
    )


@query
def clearing_filter_presentment(spark, sf_dir):
    kept = filters.keep_presentments(view(spark, sf_dir, "presentment_feed"))
    return kept.select("l00026", "l00028", "l00016", "l00045", "l00196", "l00255", "day")


@query
def clearing_filter_chargeback(spark, sf_dir):
    kept = filters.keep_chargebacks(view(spark, sf_dir, "chargeback_feed"))
    return kept.select("l00026", "l00028", "l00016", "l00045")


# ------------------------------------------------------------------- joins


@query
def bin_lookup_join(spark, sf_dir):
    joined = lookups.with_card_type(
        view(spark, sf_dir, "presentment_feed"), view(spark, sf_dir, "bins")
    )
    return joined.select("l00026", "l00028", "l00019", "c_tp_addbt")


@query
def issuer_join(spark, sf_dir):
    joined = lookups.with_known_issuer(
        view(spark, sf_dir, "presentment_feed"), view(spark, sf_dir, "issuers")
    )
    return joined.select("l00026", "l00028", "l00004")


def _categorised(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    joined = lookups.with_merchant_category(
        view(spark, sf_dir, "presentment_feed"),
        view(spark, sf_dir, "categories"),
        view(spark, sf_dir, "merchant_groups"),
        by,
    )
    return joined.select(
        "l00026", "l00028", "l00040", lookups.ALTERNATE_GROUP, "mc_description"
    )


@query
def mcc_group_join_native(spark, sf_dir):
    return _categorised(spark, sf_dir, lookups.NATIVE_GROUP)


@query
def mcc_group_join_alternate(spark, sf_dir):
    return _categorised(spark, sf_dir, lookups.ALTERNATE_GROUP)


@query
def issuer_group_join(spark, sf_dir):
    joined = lookups.with_reporting_issuer(
        presentment(spark, sf_dir),
        view(spark, sf_dir, "issuers"),
        view(spark, sf_dir, "report_groups"),
    )
    return joined.select("arn", "issuer_code", "issuer_name")


@query
def wallet_cast_join(spark, sf_dir):
    feed = view(spark, sf_dir, "presentment_feed")
    tokens = feed.select("l00026", "l00028", F.col("l00196").alias("token_requestor_id"))
    return lookups.with_wallet(tokens, view(spark, sf_dir, "wallets"))


@query
def validity_interval_join(spark, sf_dir):
    joined = lookups.within_validity(
        presentment(spark, sf_dir), view(spark, sf_dir, "periods")
    )
    return joined.select("arn", "issuer_code", "transaction_date")


@query
def validity_binned_join(spark, sf_dir):
    """The same as if the periods were too many to broadcast."""
    joined = lookups.within_validity(
        presentment(spark, sf_dir), view(spark, sf_dir, "periods"), limit=0
    )
    return joined.select("arn", "issuer_code", "transaction_date")


# -------------------------------------------------------------------- jobs


@query
def presentment(spark, sf_dir):
    return clearing.presentments(
        view(spark, sf_dir, "presentment_feed"),
        view(spark, sf_dir, "issuers"),
        view(spark, sf_dir, "bins"),
        view(spark, sf_dir, "categories"),
        view(spark, sf_dir, "merchant_groups"),
    )


def _chargebacks_of(spark: SparkSession, sf_dir: str, presented: DataFrame) -> DataFrame:
    return clearing.chargebacks(
        view(spark, sf_dir, "chargeback_feed"),
        presented,
        view(spark, sf_dir, "bins"),
        view(spark, sf_dir, "categories"),
        view(spark, sf_dir, "merchant_groups"),
    )


@query
def chargeback(spark, sf_dir):
    return _chargebacks_of(spark, sf_dir, presentment(spark, sf_dir))


@query
def chargeback_stripped(spark, sf_dir):
    return clearing.chargebacks(
        view(spark, sf_dir, "chargeback_feed"),
        presentment(spark, sf_dir),
        view(spark, sf_dir, "bins"),
        view(spark, sf_dir, "categories"),
        view(spark, sf_dir, "merchant_groups"),
        strip_keys=True,
    )


@query
def clearing_union(spark, sf_dir):
    return clearing.clearing_union(presentment(spark, sf_dir), chargeback(spark, sf_dir))


@query
def presentment_chargeback_left(spark, sf_dir):
    stored = clearing_union(spark, sf_dir)
    matched = matching.match_fraud(
        filters.stored_presentments(stored), filters.stored_fraud_chargebacks(stored)
    )
    return matched.select(
        *S.REPORT_PRESENTMENT_COLUMNS, "cb_reason_code", "cb_clearing_file_name"
    )


@query
def presentment_chargeback_counted(spark, sf_dir):
    """The same pairs, each once, with the number of times it occurs."""
    return matching.counted_pairs(
        presentment(spark, sf_dir),
        filters.stored_fraud_chargebacks(chargeback(spark, sf_dir)),
        S.REPORT_PRESENTMENT_COLUMNS,
        ["reason_code", "clearing_file_name"],
    )


@query
def scaled_amount_sum(spark, sf_dir):
    value = F.coalesce(aggregates.amount(F.col("l00033")), F.lit(0.0))
    exponent = fn.currency_exponent(F.col("l00034"))
    return (
        view(spark, sf_dir, "presentment_feed")
        .groupBy("l00004", F.col("l00034").alias("currency"), exponent.alias("exponent"))
        .agg(F.sum(value).alias("total"))
        .select(
            F.col("l00004").alias("issuer_code"),
            "currency",
            aggregates.scale(F.col("total"), F.col("exponent")).alias("amount"),
        )
    )


@query
def fraud_report(spark, sf_dir):
    stored = clearing_union(spark, sf_dir)
    return report.fraud_report(
        stored,
        stored,
        view(spark, sf_dir, "issuers"),
        view(spark, sf_dir, "report_groups"),
        view(spark, sf_dir, "periods"),
        view(spark, sf_dir, "wallets"),
    )


# --------------------------------------------------- incremental and sinks


@query
def high_water_mark(spark, sf_dir):
    source = orders(spark, sf_dir).select(
        "o_orderkey", order_date().alias("transaction_date")
    )
    number = incremental.text_date_number(F.col("transaction_date"))
    loaded = source.where(F.col("transaction_date") < NEWER_THAN)
    mark = incremental.high_water_mark(loaded, number)
    newer = incremental.newer_than(source, number, mark)
    return newer.withColumn("date_number", number)


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a partition column that is missing for some."""
    month = F.when(
        F.col("o_orderpriority") != "5-LOW", F.substring(order_date(), 1, 7)
    )
    return orders(spark, sf_dir).select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        order_date().alias("order_date"),
        month.alias("order_month"),
    )


def _written(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, text=["order_month"])


@query
def sink_append_partitioned(spark, sf_dir):
    rows, path = order_rows(spark, sf_dir), scratch_path(spark, "append")
    finished = rows.where(F.col("o_orderstatus") == "F")
    for part in (rows, finished):
        sinks.append_partitions(part, path, ["order_month"])
    return _written(spark, path)


@query
def sink_overwrite(spark, sf_dir):
    rows, path = order_rows(spark, sf_dir), scratch_path(spark, "overwrite")
    for part in (rows, rows.where(F.col("o_orderstatus") == "F")):
        sinks.overwrite(part, path, sort=["order_date"])
    return _written(spark, path)


@query
def sink_partition_replace(spark, sf_dir):
    rows, path = order_rows(spark, sf_dir), scratch_path(spark, "replace")
    sinks.append_partitions(rows, path, ["order_month"])
    of_year = F.substring("order_date", 1, 4) == MESSAGE_DAY[:4]
    reloaded = rows.where(of_year & F.col("order_month").isNotNull())
    sinks.replace_partitions(
        reloaded.withColumn("o_orderstatus", F.lit("X")), path, ["order_month"]
    )
    return _written(spark, path)


@query
def sink_sorted_layout(spark, sf_dir):
    rows, path = order_rows(spark, sf_dir), scratch_path(spark, "layout")
    sinks.append_partitions(
        rows, path, ["order_month"], sort=["order_date", "o_orderkey"]
    )
    return _written(spark, path)


@query
def sink_sorted_files(spark, sf_dir):
    """Per month, the rows and how many of them follow a larger one in their file."""
    rows, path = order_rows(spark, sf_dir), scratch_path(spark, "files")
    sinks.append_partitions(
        rows, path, ["order_month"], sort=["order_date", "o_orderkey"]
    )
    read = _written(spark, path).select(
        "order_month",
        F.struct("order_date", "o_orderkey").alias("row"),
        F.col("_metadata.file_path").alias("file"),
        F.spark_partition_id().alias("task"),
        F.monotonically_increasing_id().alias("place"),
    )
    before = F.lag("row").over(Window.partitionBy("file", "task").orderBy("place"))
    late = F.when(before > F.col("row"), 1).otherwise(0)
    return (
        read.withColumn("late", late)
        .groupBy("order_month")
        .agg(F.count("*").alias("n_rows"), F.sum("late").alias("n_unsorted"))
    )


# ----------------------------------------------------- jobs, run several times


def _stored_lookups(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, str]:
    paths = {n: scratch_path(spark, n) for n in names}
    for name, path in paths.items():
        sinks.overwrite(view(spark, sf_dir, name), path)
    return paths


def _feed_by_day(spark: SparkSession, sf_dir: str) -> str:
    """The presentment feed stored by day of import; rows come late in the second."""
    feed = scratch_path(spark, "feed")
    load_day = F.when(F.col("day") == S.HEADER_DAY, F.col("day")).otherwise(
        F.when(F.col("l00032") < "0700", "02").otherwise("01")
    )
    parts = {"year": F.lit("2024"), "month": F.lit("01"), "day": load_day}
    # a row without a day is no presentment, so its place must not give it one
    rows = view(spark, sf_dir, "presentment_feed").where("day is not null").withColumns(parts)
    sinks.append_partitions(rows, feed, list(parts), gather=False)
    return feed


@query
def presentment_incremental(spark, sf_dir):
    """Presentments loaded day of import by day of import."""
    feed, target = _feed_by_day(spark, sf_dir), scratch_path(spark, "presented")
    tables = _stored_lookups(spark, sf_dir, "issuers", "bins", "categories", "merchant_groups")
    tables["groups"] = tables.pop("merchant_groups")
    for run_date in LOADS:
        jobs.presentment_job(
            spark, feed=feed, target=target, daily=True, run_date=run_date, **tables
        )
    return read_table(spark, target)


@query
def presentment_loads(spark, sf_dir):
    """The same by load day, each of them loaded twice."""
    feed, target = _feed_by_day(spark, sf_dir), scratch_path(spark, "presented")
    tables = _stored_lookups(spark, sf_dir, "issuers", "bins", "categories", "merchant_groups")
    tables["groups"] = tables.pop("merchant_groups")
    for run_date in (*LOADS, *LOADS):
        jobs.presentment_job(
            spark, feed=feed, target=target, daily=True, run_date=run_date,
            load_column="load_date", **tables,
        )
    return read_table(spark, target, S.CLEARING_COLUMNS)


@query
def clearing_stored_by_date(spark, sf_dir):
    """The clearing tables read by path, one of them stored by date."""
    presented, back = scratch_path(spark, "presented"), scratch_path(spark, "charged-back")
    sinks.overwrite(presentment(spark, sf_dir), presented)
    charged_back = _chargebacks_of(spark, sf_dir, read_table(spark, presented))
    sinks.append_partitions(charged_back, back, ["transaction_date"])
    return clearing.clearing_union(
        read_table(spark, presented), read_table(spark, back, text=["transaction_date"])
    )


@query
def report_incremental(spark, sf_dir):
    """A report by month, brought up to date for late presentments and chargebacks."""
    late = F.coalesce(F.substring("transaction_date", 9, 2) > "20", F.lit(False))
    # what arrives is derived once, and read by every step that follows
    arriving = scratch_path(spark, "presented-all"), scratch_path(spark, "charged-back-all")
    for build, path in zip(
        (
            lambda: presentment(spark, sf_dir),
            lambda: _chargebacks_of(spark, sf_dir, read_table(spark, arriving[0], S.CLEARING_COLUMNS)),
        ),
        arriving,
        strict=True,
    ):
        sinks.append_partitions(build().withColumn("late", late), path, ["late"], gather=False)
    stored = scratch_path(spark, "presented"), scratch_path(spark, "charged-back")
    tables = _stored_lookups(spark, sf_dir, "issuers", "report_groups", "periods", "wallets")
    target = scratch_path(spark, "report")
    for arrived in ("false", "true"):
        came = F.col("late").cast("string") == arrived
        new = [
            read_table(spark, path, text=["late"]).where(came).select(*S.CLEARING_COLUMNS)
            for path in arriving
        ]
        for frame, path in zip(new, stored, strict=True):
            sinks.append(frame, path)
        touched = report.touched_months(read_table(spark, stored[0]), *new)
        jobs.report_job(
            spark, presented=stored[0], charged_back=stored[1], target=target,
            months=[r[0] for r in touched.collect()], **tables,
        )
    return read_table(spark, target, text=["month_of_report"])


@query
def report_months(spark, sf_dir):
    """Some months of the report, from presentments stored in the order of their dates."""
    stored = scratch_path(spark, "presented")
    rows = sinks.ranged(presentment(spark, sf_dir), sort=["transaction_date"], spread=["arn"])
    sinks.overwrite(rows, stored)
    presented = read_table(spark, stored, text=["transaction_date"])
    return report.fraud_report(
        presented,
        _chargebacks_of(spark, sf_dir, presented),
        view(spark, sf_dir, "issuers"),
        view(spark, sf_dir, "report_groups"),
        view(spark, sf_dir, "periods"),
        view(spark, sf_dir, "wallets"),
        months=REPORT_MONTHS,
    )


@query
def report_merged(spark, sf_dir):
    """The report from stored totals, to which each of two loads adds what it changes.

    Presentments arrive late in the month, and chargebacks of some others too; the second
    load runs twice.
    """
    late = F.coalesce(F.substring("transaction_date", 9, 2) > "20", F.lit(False))
    later = F.coalesce(late | (F.substring("issuer_code", -1, 1) > "6"), F.lit(False))
    presented, back = scratch_path(spark, "presented"), scratch_path(spark, "charged-back")
    for build, path, second in (
        (lambda: presentment(spark, sf_dir), presented, late),
        (lambda: _chargebacks_of(spark, sf_dir, read_table(spark, presented)), back, later),
    ):
        load = F.when(second, LOADS[1]).otherwise(LOADS[0])
        rows = build().withColumn("load_date", load)
        sinks.append_partitions(rows, path, ["load_date"], gather=False)
    tables = _stored_lookups(spark, sf_dir, "issuers", "report_groups", "periods", "wallets")
    totals, target = scratch_path(spark, "totals"), scratch_path(spark, "report")
    for run_date in (*LOADS, LOADS[1]):
        jobs.totals_job(
            spark, presented=presented, charged_back=back, target=totals,
            run_date=run_date, load_column="load_date", **tables,
        )
    jobs.merged_report_job(spark, totals=totals, target=target)
    return read_table(spark, target)


@query
def sink_replace_whole(spark, sf_dir):
    """A table written again without some of its months, among them that of no month."""
    rows, path = order_rows(spark, sf_dir), scratch_path(spark, "whole")
    sinks.replace_whole(rows, path, ["order_month"])
    left = rows.where(F.substring("order_month", 6, 2) != "02")
    for _ in range(2):
        sinks.replace_whole(left, path, ["order_month"])
    return _written(spark, path)


@query
def sink_range_files(spark, sf_dir):
    """Per month, rows, and files that overlap another or are over their bound."""
    rows, path = order_rows(spark, sf_dir), scratch_path(spark, "ranges")
    sinks.write_ranged(
        rows, path, ["order_month"], ["order_date"], rows_per_file=ROWS_PER_FILE,
        files=4, spread=["o_orderkey"],
    )
    files = (
        _written(spark, path)
        .groupBy("order_month", F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count("*").alias("n"),
            F.min("order_date").alias("low"),
            F.max("order_date").alias("high"),
        )
    )
    before = F.max("high").over(
        Window.partitionBy("order_month").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        files.withColumn("overlap", F.when(F.col("low") < before, 1).otherwise(0))
        .groupBy("order_month")
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum("overlap").alias("n_overlapping"),
            F.sum(F.when(F.col("n") > ROWS_PER_FILE, 1).otherwise(0)).alias("n_over"),
        )
    )


@query
def chargeback_colocated(spark, sf_dir):
    """Chargebacks matched to presentments stored in buckets, an ARN in four of them."""
    table = f"presented_{uuid4().hex}"
    parts = matching.with_arn_part(presentment(spark, sf_dir), 4)
    sinks.overwrite_bucketed(
        parts, table, ["arn", matching.ARN_PART], 8, path=scratch_path(spark, "buckets")
    )
    return clearing.chargebacks(
        view(spark, sf_dir, "chargeback_feed"),
        read_table(spark, table),
        view(spark, sf_dir, "bins"),
        view(spark, sf_dir, "categories"),
        view(spark, sf_dir, "merchant_groups"),
        arn_parts=4,
    )
