"""Authorization messages: edge documents, and the literal explode-and-group form."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cardlake import schemas as S
from cardlake.plans import authorization as auth
from fixtures.adapters import MESSAGES, view
from fixtures.queries import QUERIES
from tests.compare import spark_rows
from tests.literal import exploded_pivot, repeated_parse


def frame_of(spark, *documents):
    rows = [("2024-01-01", d if isinstance(d, str) else json.dumps(d)) for d in documents]
    return spark.createDataFrame(rows, "time_stamp string, json_field string")


def tags(*pairs, key="field_tag"):
    return {"subfield": [{key: k, "field_value": v} for k, v in pairs]}


def one(spark, document):
    (row,) = auth.authorization_trace(frame_of(spark, document), "2024-02-29").collect()
    return row


def test_layout(spark):
    row = one(spark, {})
    assert row.__fields__ == S.AUTH_COLUMNS and len(S.AUTH_COLUMNS) == 32
    assert row.Circuit == "VISA" and row.Elaboration_Date == "20240229"


def test_largest_text_wins_for_a_repeated_tag(spark):
    row = one(spark, {"DE123_ss": tags(("05", "15"), ("05", "2"), ("03", "9"), ("05", None))})
    assert row.Token_Id == "2"
    assert row.Correlation_Id == "29"


def test_correlation_needs_both_parts(spark):
    assert one(spark, {"DE123_ss": tags(("05", "15"))}).Correlation_Id is None


@pytest.mark.parametrize(
    "element",
    [None, {}, {"subfield": None}, {"subfield": []}, {"subfield": [None]},
     {"subfield": "text"}, "text", {"subfield": {"field_tag": "05"}}],
)
def test_arrays_without_usable_items(spark, element):
    row = one(spark, {"DE2_ss": {"field_value": "4"}, "DE123_ss": element})
    assert row.Primary_Account_Number == "4"
    assert row.Token_Id is None


def test_keys_of_each_array(spark):
    document = {
        "DE123_ss": tags(("01", "a"), ("06", "b"), ("07", "c"), ("08", "d")),
        "DE125_ss": tags(("01", "e"), ("03", "f")),
        "DE63_ss": tags(("1", "g"), ("3", "h"), key="field_id"),
    }
    row = one(spark, document)
    picked = (row.Token, row.Token_Expiry_Date, row.Token_Type, row.Token_State,
              row.Wallet_Provider_Risk_Assessment, row.Device_Id, row.Network_Data,
              row.Message_Reason_Code)
    assert picked == tuple("abcdefgh")


@pytest.mark.parametrize("document", ['{"id": "a 24-01-01 b"', "not json", ""])
def test_malformed_message_keeps_its_row(spark, document):
    row = one(spark, document)
    assert row.Circuit == "VISA"
    assert row.Message_Type is None and row.Token_Timestamp is None


def test_timestamp_and_partition_date(spark):
    dated = {"id": "m 24-03-05 x", "DE7_ss": {"field_value": "0304112233"}}
    row = one(spark, dated)
    assert row.Token_Timestamp == "2024-03-04 11:22:33.000"
    assert row.Token_Date == "2024-03-04"
    assert one(spark, dated | {"id": "none"}).Token_Date == "20-03-04 1"
    assert one(spark, {"id": "m 24-03-05 x"}).Token_Date is None


def test_equals_explode_and_group(spark, sf_dir):
    messages = view(spark, sf_dir, MESSAGES)
    names = [n for _, t in S.TAGGED_ELEMENTS.values() for n in t.values()]
    fields = auth.message_fields(messages).select(*names)
    assert spark_rows(fields) == spark_rows(exploded_pivot(messages).select(*names))


def test_equals_one_parse_per_column(spark, sf_dir):
    messages = view(spark, sf_dir, MESSAGES)
    names = list(S.SIMPLE_ELEMENTS.values())
    parsed = auth.parse_messages(messages).select(*names)
    assert spark_rows(parsed) == spark_rows(repeated_parse(messages).select(*names))


def test_yesterday_is_the_default_slice(spark):
    from cardlake.sources import day_slice

    days = spark.range(3).select(
        F.date_sub(F.current_date(), F.col("id").cast("int")).cast("string").alias("d")
    )
    (row,) = day_slice(days, "d").collect()
    (expected,) = spark.range(1).select(
        F.date_sub(F.current_date(), 1).cast("string")
    ).first()
    assert row.d == expected


def test_elements_that_are_not_wanted_are_skipped(spark, sf_dir):
    """Others may be missing, odd or cut short: what is read stays the same."""
    documents = [
        {"id": "a", "DE37_ss": {"field_value": "1"}, "DE123_ss": tags(("05", "2")), "DE2_ss": "odd"},
        {"id": "b", "DE37_ss": {"field_value": "1"}, "DE123_ss": "text", "DE125_ss": 7},
        {"DE123_ss": tags(("05", None)), "DE63_ss": [1]},
        '{"id": "c", "DE37_ss": {"field_value": "1"}, "DE125_ss": {"subfield": [{"field',
        "not json",
    ]
    names = ["message_id", "Retrieval_Reference_Number", "subfields_123"]
    for messages in (frame_of(spark, *documents), view(spark, sf_dir, MESSAGES)):
        some = auth.parse_messages(messages, elements=[37, 123])
        assert some.columns == names
        whole = auth.parse_messages(messages).select(*names)
        text = [F.col(c).cast("string") for c in names]
        assert spark_rows(some.select(*text)) == spark_rows(whole.select(*text))


def test_text_of_a_message_is_made_before_it_is_parsed(spark, sf_dir):
    """Parsing is interpreted, and so would be whatever Spark merges into it."""
    trace = auth.authorization_trace(view(spark, sf_dir, MESSAGES), "2024-02-29")
    plan = trace._jdf.queryExecution().optimizedPlan().toString()
    parsing = [line for line in plan.splitlines() if "from_json" in line]
    assert len(parsing) == 1 and "to_json" not in parsing[0]


def test_pivot_of_some_elements_parses_no_others(spark, sf_dir):
    fields = auth.message_fields(view(spark, sf_dir, MESSAGES), elements=[37, 63])
    names = ["message_id", "Retrieval_Reference_Number", "Network_Data", "Message_Reason_Code"]
    assert fields.columns == names
    whole = auth.message_fields(view(spark, sf_dir, MESSAGES)).select(*names)
    assert spark_rows(fields) == spark_rows(whole)
    plan = QUERIES["tag_pivot"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    parsing = [line for line in plan.splitlines() if "from_json" in line]
    assert len(parsing) == 1 and "DE2_ss" not in parsing[0] and "DE123_ss" in parsing[0]
