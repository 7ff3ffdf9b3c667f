"""Authorization messages: nested JSON to one flat row per message."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake import schemas as S

_SIMPLE = list(S.SIMPLE_ELEMENTS.values())


def _subfields(number: int) -> str:
    return f"subfields_{number}"


def parse_messages(
    messages: DataFrame,
    column: str = "json_field",
    *,
    elements: Collection[int] | None = None,
) -> DataFrame:
    """Message id, simple elements and sub-field arrays, from a single JSON parse.

    A malformed message keeps its row, with every field NULL; an element of
    the wrong shape is NULL by itself. With ``elements`` only these are parsed and
    returned, and others are skipped: Spark does not leave out unused ones by itself.
    """
    schema = S.message_schema(elements)
    # Parsing is not generated code, and what is merged into it is interpreted as well. A
    # text that is used twice is not merged: Spark makes it in a projection of its own.
    text = F.col(column)
    document = F.when(text.isNotNull(), F.from_json(text, schema))
    parsed = messages.select(document.alias("m"))
    simple = [
        F.col(f"m.DE{number}_ss.field_value").alias(name)
        for number, name in S.SIMPLE_ELEMENTS.items()
        if f"DE{number}_ss" in schema.names
    ]
    arrays = [
        F.col(f"m.DE{number}_ss.subfield").alias(_subfields(number))
        for number in S.TAGGED_ELEMENTS
        if f"DE{number}_ss" in schema.names
    ]
    return parsed.select(F.col("m.id").alias("message_id"), *simple, *arrays)


def _tagged(numbers: Collection[int]) -> list[Column]:
    return [
        fn.tag_value(F.col(_subfields(number)), key, wanted).alias(name)
        for number, (key, tags) in S.TAGGED_ELEMENTS.items()
        if number in numbers
        for wanted, name in tags.items()
    ]


def message_fields(
    messages: DataFrame,
    column: str = "json_field",
    *,
    elements: Collection[int] | None = None,
) -> DataFrame:
    """Simple elements and pivoted sub-fields of every message, or those of ``elements``."""
    parsed = parse_messages(messages, column, elements=elements)
    numbers = [n for n in S.TAGGED_ELEMENTS if _subfields(n) in parsed.columns]
    simple = [name for name in _SIMPLE if name in parsed.columns]
    ordered = {name: fn.order_subfields(F.col(name)) for name in map(_subfields, numbers)}
    return parsed.withColumns(ordered).select("message_id", *simple, *_tagged(numbers))


def authorization_trace(
    messages: DataFrame,
    elaboration_date: str | None = None,
    circuit: str = S.CIRCUIT,
    column: str = "json_field",
) -> DataFrame:
    """The 32-column authorization row of every message.

    Each message is handled inside its own row, so the plan has no shuffle and
    its cost follows the bytes read. ``elaboration_date`` is today by default.
    """
    today = (
        F.current_date()
        if elaboration_date is None
        else F.lit(elaboration_date).cast("date")
    )
    fields = message_fields(messages, column)
    stamped = fields.withColumn(
        "Token_Timestamp",
        fn.message_timestamp(
            fn.message_year(F.col("message_id")), F.col("Month_Day_Hour_Minute_Seconds")
        ),
    )
    completed = stamped.withColumns(
        {
            "Circuit": F.lit(circuit),
            "Correlation_Id": F.concat("Token_Id", "Token_Requestor_id"),
            "Elaboration_Date": fn.compact_date(today),
            "Token_Date": F.substring("Token_Timestamp", 1, 10),
        }
    )
    return completed.select(*S.AUTH_COLUMNS)
