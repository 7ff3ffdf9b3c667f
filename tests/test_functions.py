"""Expressions on hand-written edge rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake.functions.text import BLANKS


def evaluate(spark, expression, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[1] for r in frame.select("i", expression(F.col("v"))).orderBy("i").collect()]


STRIPPED = [None, "", "  ", "\t a \n", "\x1cx\x1f", "\xa0q\x85", " a b ", "​z",
            "　w ", "\x00n"]


def test_strip_equals_python(spark):
    expected = ["" if v is None else v.strip() for v in STRIPPED]
    assert evaluate(spark, fn.strip, STRIPPED) == expected


def test_blanks_are_all_white_space():
    assert set(BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@pytest.mark.parametrize(
    ("decoder", "cases"),
    [
        (fn.token_flag, {None: "Y", "": "Y", "ALL SPACE": "N", "LOW-VALUE": "N",
                         "ZEROE": "N", "ALL-SPACE": "Y", "all space": "Y"}),
        (fn.token_pan, {None: None, "": "", "ALL SPACE": "ALL-SPACE",
                        "LOW-VALUE": "ALL-SPACE", "ZEROE": "ALL-SPACE", "4": "4"}),
        (fn.currency_exponent, {None: None, "978": "2", "840": None, " 978": None}),
        (fn.remote_flag, {None: "N", "4": "N", "5": "Y", "6": "Y", "7": "Y", "8": "Y",
                          "9": "N", "07": "N"}),
        (fn.contactless_flag, {None: "N", "07": "Y", "7": "N"}),
        (fn.fraud_flag, {None: "N", "4837": "Y", "4840": "Y", "4849": "Y",
                         "4863": "Y", "4870": "Y", "4871": "Y", "4838": "N"}),
    ],
)
def test_decoders(spark, decoder, cases):
    assert evaluate(spark, decoder, list(cases)) == list(cases.values())


def test_bin_key(spark):
    cases = {
        None: None,
        "": 0,
        "401288": 40128800,
        "40128888": 40128888,
        "4012888812345678": 40128888,
        "40128888123456789012345": 40128888,
        "4012 88812345678": None,
        "XXXX": None,
    }
    assert evaluate(spark, fn.bin_key, list(cases)) == list(cases.values())


def test_integer_key_survives_dirty_text(spark):
    cases = {"50120834693": 50120834693, " 12 ": 12, "n/a": None, "": None}
    assert evaluate(spark, fn.integer_key, list(cases)) == list(cases.values())


def test_arn_with_a_missing_part(spark):
    parts = "l00026 string, l00027 string, l00028 string, l00029 string, l00030 string"
    rows = [("7", "1", "2", "3", "4 "), ("7", "1", None, "3", "4"), ("", "", "", "", "")]
    frame = spark.createDataFrame(rows, parts).select(fn.raw_arn(), fn.arn())
    assert [tuple(r) for r in frame.collect()] == [
        ("71234 ", "71234"), (None, ""), ("", ""),
    ]


def test_message_year_and_timestamp(spark):
    ids = {
        "A 97-05-28 B": "97",
        "x97-05-28": "",
        "97-05-28 x": "",
        "no date": "",
        "a 01-02-03 04-05-06 b": "01",
        None: None,
    }
    assert evaluate(spark, fn.message_year, list(ids)) == list(ids.values())

    rows = [("97", "0528101530"), ("", "0528101530"), (None, "0528101530"), ("97", None),
            ("97", "05")]
    frame = spark.createDataFrame(rows, "y string, t string")
    stamps = frame.select(fn.message_timestamp(F.col("y"), F.col("t"))).collect()
    assert [r[0] for r in stamps] == [
        "2097-05-28 10:15:30.000", "20-05-28 10:15:30.000", None, None,
        "2097-05- ::.000",
    ]


def test_clearing_date_keeps_the_import_year(spark):
    rows = [("2020-01-03 10:00:00", "1231"), ("2020-01-03", "1332"), ("2020-01-03", None),
            (None, "0101")]
    frame = spark.createDataFrame(rows, "imported string, md string")
    dates = frame.select(fn.clearing_date(F.col("imported"), F.col("md"))).collect()
    assert [r[0] for r in dates] == ["2020-12-31", "2020-13-32", None, None]


def test_date_parts_never_fail(spark):
    values = ["2019-02-28", "2019-13-07", "2019-02-28 23:59:59", "junk", None]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    parts = frame.select(*fn.date_parts(F.col("v")), fn.month_bucket(F.col("v"))).collect()
    none = (None, None, None, None)
    assert [tuple(r) for r in parts] == [
        (2019, 2, 28, "201902"), none, (2019, 2, 28, "201902"), none, none,
    ]
