"""Straightforward forms of what the library does, to compare results and time.

They explode, group, call Python per row and parse JSON once per column: the
way these jobs look when written without regard to cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake import schemas as S


def _document(column: str = "json_field"):
    return F.from_json(column, S.message_schema())


def repeated_parse(messages: DataFrame) -> DataFrame:
    """Simple elements, the document parsed anew for each of them."""
    rows = messages
    for number, name in S.SIMPLE_ELEMENTS.items():
        value = _document()[f"DE{number}_ss"]["field_value"]
        rows = rows.withColumn(name, value)
    return rows


def exploded_pivot(messages: DataFrame) -> DataFrame:
    """Sub-fields exploded into a cross product per message, then grouped back."""
    rows = messages.withColumn("row_id", F.monotonically_increasing_id())
    rows = rows.select("row_id", _document().alias("m"))
    kept = ["row_id"]
    picked = []
    for number, (key, tags) in S.TAGGED_ELEMENTS.items():
        items = rows.select(
            *[c for c in rows.columns], F.inline_outer(f"m.DE{number}_ss.subfield")
        )
        rows = items.withColumnsRenamed(
            {key: f"key_{number}", "field_value": f"value_{number}"}
        )
        kept += [f"key_{number}", f"value_{number}"]
        for wanted, name in tags.items():
            hit = F.when(F.col(f"key_{number}") == wanted, F.col(f"value_{number}"))
            picked.append(F.max(hit).alias(name))
    return rows.select(*kept).groupBy("row_id").agg(*picked)


def _python(rule):
    return F.udf(rule, T.StringType(), useArrow=False)


def python_decoders(feed: DataFrame) -> DataFrame:
    """The decoded columns of a feed, each through a Python function per row."""
    flag = {True: "Y", False: "N"}
    empty = set(S.EMPTY_MARKERS)
    remote = set(S.REMOTE_INDICATORS)
    fraud = set(S.FRAUD_REASONS)
    strip = _python(lambda v: "" if v is None else v.strip())
    token = _python(lambda v: flag[v not in empty])
    pan = _python(lambda v: S.EMPTY_TOKEN if v in empty else v)
    digits = _python(S.CURRENCY_EXPONENTS.get)
    return feed.select(
        strip("l00019").alias("funding_pan"),
        strip(F.concat(*S.ARN_PARTS)).alias("arn"),
        strip("l00328").alias("trace_id"),
        token("l00255").alias("mdes_flag"),
        pan("l00255").alias("dpan"),
        digits("l00034").alias("p_exp_rcnc"),
        _python(lambda v: flag[v in remote])("l00074").alias("remote_trx_flag"),
        _python(lambda v: flag[v == S.CONTACTLESS_ENTRY])("l00054").alias(
            "nfc_technology_flag"
        ),
        _python(lambda v: flag[v in fraud])("l00046").alias("fraud_flag"),
    )


def literal_report(
    clearing: DataFrame,
    issuers: DataFrame,
    report_groups: DataFrame,
    periods: DataFrame,
    wallets: DataFrame,
) -> DataFrame:
    """Report totals by joining every matching pair first and filtering last."""
    fp = clearing.where(F.col("message_type_identifier") == S.PRESENTMENT_TYPE)
    fp = fp.select(*S.REPORT_PRESENTMENT_COLUMNS).alias("fp")
    cb = clearing.where(
        (F.col("message_type_identifier") == S.CHARGEBACK_TYPE)
        & (F.col("fraud_flag") == "Y")
        & (F.col("mdes_flag") == "Y")
    ).alias("cb")
    members = issuers.join(
        report_groups.where(F.col("id") == S.REPORT_ID), "group_code"
    ).alias("i")
    wallet = wallets.where(F.col("token_requestor_name") == S.WALLET_NAME).alias("w")
    pairs = (
        fp.join(cb, [F.col(f"fp.{k}") == F.col(f"cb.{k}") for k in S.MATCH_KEYS], "left")
        .join(members, F.col("fp.issuer_code") == F.col("i.issuer_code"))
        .join(periods.alias("v"), F.col("fp.issuer_code") == F.col("v.issuer_code"))
        .join(
            wallet, F.col("fp.token_requestor_id") == F.col("w.token_requestor_id")
        )
        .where(
            F.col("fp.transaction_date").between(
                F.col("start_attivation"), F.col("end_attivation")
            )
        )
    )
    value = F.when(F.col("cb.v_rcnc").isNull(), 0.0).otherwise(
        F.expr("try_cast(cb.v_rcnc as double)")
    )
    month = F.date_format(F.expr("try_cast(fp.transaction_date as date)"), "yyyyMM")
    keys = ["fp.issuer_code", "fp.bin_code", "fp.c_dv_rcnc", "fp.p_exp_rcnc"]
    return pairs.groupBy(month.alias("month_of_report"), *keys).agg(
        (F.sum(value) / F.pow(F.lit(10.0), F.expr("try_cast(fp.p_exp_rcnc as double)")))
        .alias("reconciliation_amount"),
        F.count("cb.v_rcnc").alias("total_transaction"),
        F.max("fp.transaction_date").alias("last_date"),
    )
