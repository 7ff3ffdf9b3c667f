"""Clearing feed to presentments and chargebacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake import schemas as S
from cardlake.operators import filters, lookups, matching


def _text_null() -> Column:
    # Typed: ORC has no column of unknown type.
    return F.lit(None).cast("string")


def _decoded(message_type: str, circuit: str, file_stamp: str) -> dict[str, Column]:
    """Columns both message types take from their own feed row."""
    feed = F.col
    return {
        "source_platform": fn.source_platform(feed("circuito")),
        "message_type_identifier": F.lit(message_type),
        "abi_code": _text_null(),
        "issuer_code": feed("l00004"),
        "bin_code": fn.bin_code(feed("l00019")),
        "funding_pan": fn.strip(feed("l00019")),
        "card_type": feed("c_tp_addbt"),
        "arn": fn.arn(),
        "trace_id": fn.strip(feed("l00328")),
        "reason_code": feed("l00046"),
        "token_requestor_id": F.lit(S.TOKEN_REQUESTOR_ID).cast("bigint"),
        "remote_trx_flag": fn.remote_flag(feed("l00074")),
        "nfc_technology_flag": fn.contactless_flag(feed("l00054")),
        "pos_entry_mode": feed("l00054"),
        "cod_terminale": feed("l00072"),
        "cod_esercente": feed("l00071"),
        "merchant_name": feed("l00037"),
        "merchant_address": _text_null(),
        "merchant_city": feed("l00038"),
        "merchant_country": feed("l00039"),
        "merchant_type": feed("l00042"),
        "mc_group_code": feed(lookups.ALTERNATE_GROUP),
        "mc_description": feed("mc_description"),
        "c_activity": F.lit(S.ACTIVITY_CODE),
        "circuit": F.lit(circuit),
        "clearing_file_name": fn.file_name(
            feed("circuito"), feed(file_stamp), feed("ticket")
        ),
        "transaction_date": fn.clearing_date(feed("import_timestamp"), feed("l00032")),
    }


def presentments(
    feed: DataFrame,
    issuers: DataFrame,
    bins: DataFrame,
    categories: DataFrame,
    groups: DataFrame,
    *,
    circuit: str = S.CIRCUIT,
) -> DataFrame:
    """The 34-column presentments of a clearing feed.

    The feed is filtered on stored columns and meets look-up tables only, so
    it is neither shuffled nor seen by Python. The merchant group is looked up
    by the circuit's own group code.
    """
    kept = filters.keep_presentments(feed)
    known = lookups.with_known_issuer(kept, issuers)
    categorised = lookups.with_merchant_category(
        known, categories, groups, lookups.NATIVE_GROUP, circuit
    )
    typed = lookups.with_card_type(categorised, bins)
    columns = _decoded(S.PRESENTMENT_TYPE, circuit, file_stamp="l00032")
    columns |= {
        "fraud_flag": F.lit("N"),
        "mdes_flag": fn.token_flag(F.col("l00255")),
        "dpan": fn.token_pan(F.col("l00255")),
        "token_assur_lev": F.col("l00062"),
        "v_rcnc": F.col("l00033"),
        "c_dv_rcnc": F.col("l00034"),
        "p_exp_rcnc": fn.currency_exponent(F.col("l00034")),
    }
    return typed.select(*[columns[c].alias(c) for c in S.CLEARING_COLUMNS])


def chargebacks(
    feed: DataFrame,
    clearing: DataFrame,
    bins: DataFrame,
    categories: DataFrame,
    groups: DataFrame,
    *,
    circuit: str = S.CIRCUIT,
    since: str | None = None,
    strip_keys: bool = False,
    salts: int = 1,
    arn_parts: int = 1,
) -> DataFrame:
    """The 34-column chargebacks of a clearing feed.

    Token and amount columns come from the presentment in ``clearing`` with
    the same ARN; ``since`` bounds the presentment dates searched. ``arn_parts`` is the
    number of parts that ``clearing`` was stored with, see ``matching``. The merchant
    group is looked up by the other circuit's group code here. Look-ups and
    decoding come first: only rows that can appear in the result, at their
    final width, are shuffled for the ARN.
    """
    kept = filters.keep_chargebacks(feed)
    categorised = lookups.with_merchant_category(
        kept, categories, groups, lookups.ALTERNATE_GROUP, circuit
    )
    typed = lookups.with_card_type(categorised, bins)
    columns = _decoded(S.CHARGEBACK_TYPE, circuit, file_stamp="l00022")
    columns["fraud_flag"] = fn.fraud_flag(F.col("l00046"))
    decoded = typed.select(
        *[c.alias(name) for name, c in columns.items()], *S.ARN_PARTS
    )
    matched = matching.inherit_from_presentment(
        decoded,
        filters.stored_presentments(clearing, since),
        strip_keys=strip_keys,
        salts=salts,
        arn_parts=arn_parts,
    )
    return matched.select(*S.CLEARING_COLUMNS)


def clearing_union(presented: DataFrame, charged_back: DataFrame) -> DataFrame:
    """Both message types as the one table the report reads."""
    return presented.unionByName(charged_back)
