"""Presentments, chargebacks and the report on small hand-written tables."""

from __future__ import annotations

import pytest

from cardlake import schemas as S
from cardlake.operators import filters, matching
from cardlake.plans import chargebacks, clearing_union, fraud_report, presentments
from fixtures.adapters import view
from fixtures.queries import QUERIES
from tests.compare import spark_rows
from tests.literal import literal_report

FEED_ROW = {
    "l00004": "03069", "l00016": "05", "l00019": " 4012888812345678 ", "l00022": "0102",
    "l00026": "7", "l00027": "1", "l00028": "2", "l00029": "3", "l00030": "4",
    "l00032": "1231", "l00033": "1050", "l00034": "978", "l00037": "Shop",
    "l00038": "Roma", "l00039": "IT", "l00040": "5411", "l00042": "T", "l00045": "1",
    "l00046": "4837", "l00054": "07", "l00062": "02", "l00071": "E1", "l00072": "T1",
    "l00074": "5", "l00196": "40", "l00255": "ZEROE", "l00328": " tr ",
    "circuito": "VISA", "ticket": "01", "import_timestamp": "2020-01-03 10:00:00",
    "day": "03",
}


def feed(spark, *changes):
    """Feed rows, each the standard row with some values changed."""
    rows = [{**FEED_ROW, "l00019": "4012888812345678 ", **c} for c in changes or ({},)]
    names = S.CLEARING_FEED.names
    return spark.createDataFrame([[r[n] for n in names] for r in rows], S.CLEARING_FEED)


def lookups(spark, bins=(("40128888", "C"),)):
    return {
        "bins": spark.createDataFrame(list(bins), "c_pan_visa string, c_tp_addbt string"),
        "categories": spark.createDataFrame(
            [("5411", "V1", "M1", "Grocery"), ("6011", "V9", "M1", "ATM")],
            "mc_code string, visa_mc_group_code string, "
            "mastercard_mc_group_code string, mc_description string",
        ),
        "groups": spark.createDataFrame(
            [("V1", "VISA"), ("M1", "VISA"), ("V9", "MAST")],
            "mc_group_code string, circuit string",
        ),
    }


def issuers(spark):
    return spark.createDataFrame(
        [("03069", "Bank", "G")],
        "issuer_code string, issuer_name string, group_code string",
    )


def presented(spark, *changes, **tables):
    return presentments(feed(spark, *changes), issuers(spark), **lookups(spark, **tables))


def charged_back(spark, clearing, *changes, **options):
    changes = [{"l00016": "15", **c} for c in changes or ({},)]
    return chargebacks(feed(spark, *changes), clearing, **lookups(spark), **options)


def test_presentment_row(spark):
    (row,) = presented(spark).collect()
    assert row.asDict() == {
        "source_platform": "VI", "message_type_identifier": "1240", "abi_code": None,
        "issuer_code": "03069", "bin_code": "401288", "funding_pan": "4012888812345678",
        "card_type": "C", "arn": "71234", "trace_id": "tr", "reason_code": "4837",
        "fraud_flag": "N", "mdes_flag": "N", "dpan": "ALL-SPACE",
        "token_assur_lev": "02", "token_requestor_id": 50120834693,
        "remote_trx_flag": "Y", "nfc_technology_flag": "Y", "pos_entry_mode": "07",
        "cod_terminale": "T1", "cod_esercente": "E1", "merchant_name": "Shop",
        "merchant_address": None, "merchant_city": "Roma", "merchant_country": "IT",
        "merchant_type": "T", "mc_group_code": "M1", "mc_description": "Grocery",
        "v_rcnc": "1050", "c_dv_rcnc": "978", "p_exp_rcnc": "2", "c_activity": "I",
        "circuit": "VISA", "clearing_file_name": "VISA123101",
        "transaction_date": "2020-12-31",
    }
    assert row.__fields__ == S.CLEARING_COLUMNS


@pytest.mark.parametrize(
    "change",
    [{"day": "day"}, {"day": None}, {"l00045": "0"}, {"l00045": None}, {"l00016": "15"},
     {"l00255": None}, {"l00196": None}, {"l00004": "99999"}, {"l00040": "6011"},
     {"l00040": "0000"}, {"l00019": "4012 8888"}, {"l00019": "5012888812345678"},
     {"l00019": None}],
)
def test_presentments_left_out(spark, change):
    assert presented(spark, change).count() == 0


def test_matching_bins_multiply(spark):
    rows = presented(spark, bins=[("40128888", "C"), ("040128888", "D"), ("bad", "X")])
    assert sorted(r.card_type for r in rows.collect()) == ["C", "D"]


def test_group_is_looked_up_differently_for_chargebacks(spark):
    original = presented(spark)
    # Category 6011 belongs to the circuit by its alternate group only.
    (row,) = charged_back(spark, original, {"l00040": "6011"}).collect()
    assert row.mc_description == "ATM"


def test_chargeback_takes_over_the_presentment(spark):
    original = presented(spark, {"l00255": "D1", "l00033": "77", "l00062": "09"})
    (row,) = charged_back(spark, original, {"l00004": "unknown", "l00033": "5"}).collect()
    assert row.__fields__ == S.CLEARING_COLUMNS
    assert (row.message_type_identifier, row.fraud_flag) == ("1442", "Y")
    assert (row.mdes_flag, row.dpan, row.token_assur_lev, row.v_rcnc) == (
        "Y", "D1", "09", "77",
    )
    assert row.clearing_file_name == "VISA010201"
    assert row.issuer_code == "unknown"


def test_arn_is_compared_as_delivered(spark):
    original = presented(spark, {"l00030": "4 "})
    late = {"l00030": "4 "}
    assert charged_back(spark, original, late).count() == 0
    assert charged_back(spark, original, late, strip_keys=True).count() == 1


def test_arn_with_a_missing_part_matches_nothing(spark):
    original = presented(spark, {"l00028": None})
    assert [r.arn for r in original.collect()] == [""]
    assert charged_back(spark, original, {"l00028": None}).count() == 0


def test_shared_arn_multiplies_and_since_bounds(spark):
    original = presented(spark, {}, {"l00032": "0102"}, {"l00032": "0101"})
    assert charged_back(spark, original).count() == 3
    assert charged_back(spark, original, since="2020-01-02").count() == 2


def test_chargebacks_do_not_serve_as_presentments(spark):
    original = presented(spark)
    both = clearing_union(original, charged_back(spark, original))
    assert charged_back(spark, both).count() == 1


# ------------------------------------------------------------------ report


def report(spark, clearing, periods=(("2020-12-31", "2020-12-31"),), **options):
    groups = [("G", "GP001"), ("H", "GP002")]
    wallets = [(50120834693, "Google Pay"), (50120834693, "Other")]
    return fraud_report(
        clearing,
        clearing,
        issuers(spark),
        spark.createDataFrame(groups, "group_code string, id string"),
        spark.createDataFrame(
            [("03069", *p) for p in periods],
            "issuer_code string, start_attivation string, end_attivation string",
        ),
        spark.createDataFrame(
            wallets, "token_requestor_id bigint, token_requestor_name string"
        ),
        **options,
    )


TOKEN = {"l00255": "D1"}


def test_report_row(spark):
    original = presented(spark, TOKEN, {**TOKEN, "l00027": "9", "l00032": "1230"})
    clearing = clearing_union(original, charged_back(spark, original))
    (row,) = report(spark, clearing, [("2020-12-01", "2020-12-31")]).collect()
    assert row.__fields__ == S.REPORT_COLUMNS
    assert tuple(row) == (
        "202012", "03069", "401288", "Bank", 50120834693, "Google Pay", "978", "2",
        10.5, 1, 2020, 12, 31,
    )


@pytest.mark.parametrize(
    ("periods", "rows"),
    [([("2020-12-31", "2020-12-31")], 1), ([("2020-12-31", "2021-12-31")], 1),
     ([("2021-01-01", "2021-12-31")], 0), ([("2020-01-01", "2020-12-30")], 0)],
)
def test_period_ends_are_inside(spark, periods, rows):
    assert report(spark, presented(spark, TOKEN), periods).count() == rows


def test_overlapping_periods_multiply(spark):
    original = presented(spark, TOKEN)
    clearing = clearing_union(original, charged_back(spark, original, {}, {}))
    twice = [("2020-01-01", "2021-01-01"), ("2020-06-01", "2021-06-01")]
    (row,) = report(spark, clearing, twice).collect()
    assert (row.reconciliation_amount, row.total_transaction) == (42.0, 4)


@pytest.mark.parametrize(("currency", "amount"), [("978", 0.0), ("840", None)])
def test_group_without_fraud_stays(spark, currency, amount):
    (row,) = report(spark, presented(spark, {**TOKEN, "l00034": currency})).collect()
    assert (row.reconciliation_amount, row.total_transaction) == (amount, 0)


def test_untokenised_and_other_reasons_are_no_fraud(spark):
    plain, token = presented(spark), presented(spark, TOKEN)
    for original, change in ((plain, {}), (token, {"l00046": "2502"})):
        clearing = clearing_union(original, charged_back(spark, original, change))
        (row,) = report(spark, clearing).collect()
        assert row.total_transaction == 0


def test_unreadable_amount_counts_but_does_not_add(spark):
    original = presented(spark, {**TOKEN, "l00033": "1O5"})
    clearing = clearing_union(original, charged_back(spark, original))
    (row,) = report(spark, clearing).collect()
    assert (row.reconciliation_amount, row.total_transaction) == (None, 1)


def test_impossible_date_has_its_own_group(spark):
    original = presented(spark, {**TOKEN, "l00032": "1332"})
    (row,) = report(spark, original, [("2020-01-01", "2020-99-99")]).collect()
    assert (row.month_of_report, row.year_of_last_elaboration_date) == (None, None)


def test_counting_equals_pairing(spark, sf_dir):
    """The report equals joining all pairs, as does the plain left join."""
    clearing = QUERIES["clearing_union"](spark, sf_dir)
    tables = [
        view(spark, sf_dir, n) for n in ("issuers", "report_groups", "periods", "wallets")
    ]
    literal = literal_report(clearing, *tables)
    ours = fraud_report(clearing, clearing, *tables)
    names = ["month_of_report", "issuer_code", "bin_code", "total_transaction",
             "reconciliation_amount"]
    assert spark_rows(ours.select(*names)) == spark_rows(literal.select(*names))

    presented_rows = filters.stored_presentments(clearing)
    fraud = filters.stored_fraud_chargebacks(clearing)
    pairs = matching.match_fraud(presented_rows, fraud).where("cb_arn is not null")
    counted = matching.count_fraud(presented_rows, fraud, ["transaction_date"])
    hits = counted.selectExpr("sum(n_presented * fraud_count)", "sum(n_presented)").first()
    assert (pairs.count(), presented_rows.count()) == tuple(hits)


def test_stripped_keys_leave_missing_arns_unmatched(spark):
    original = presented(spark, {"l00028": None})
    blank = dict.fromkeys(["l00026", "l00027", "l00028", "l00029", "l00030"], " ")
    for change in ({"l00028": None}, blank):
        assert charged_back(spark, original, change, change, strip_keys=True).count() == 0
