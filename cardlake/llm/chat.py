"""Chat formatting with every participant in turn as the assistant.

For each participant of a conversation the whole dialogue is rendered with that
speaker as assistant and all others as named users; spans mark the text to train on.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Roles that take no part: they keep their role in every perspective.
CONTEXT = ["system"]
#: Turn numbers that are rendered as one row; longer dialogues have several.
PART_TURNS = 256


def _clean(text: Column) -> Column:
    """Text that cannot be taken for a delimiter."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(role: Column, speaker: Column) -> Column:
    return F.concat(
        F.lit(OPEN),
        F.when(role.isin(CONTEXT), role)
        .when(role == speaker, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), role)),
        F.lit("\n"),
    )


def rotated(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, speaker, part, n_turns, rendered, mask for every participant.

    ``conversations`` has conv_id, turn, role, text; other columns are left out. Turns
    are ordered by turn, role, text (nulls first); repeated rows are turns of their own.
    A null role is the participant ``unknown``; a null text is an empty turn, a null conv_id
    one conversation, a null turn comes first. Roles in ``CONTEXT`` stay as they are and are
    nobody's perspective; a conversation with no other role gives no rows. ``<|`` within
    texts and roles is written ``< |``.

    ``mask`` lists spans (start, end; code points of ``rendered``, end exclusive) of
    what the assistant says, its end mark included. Turn numbers from 256 k up to
    256 k + 255 (``part_turns``) form part k: a conversation of any length is rendered in
    rows of bounded size, to be read one after the other.
    """
    role = _clean(F.coalesce("role", F.lit("unknown")))
    turns = conversations.select(
        "conv_id",
        "turn",
        role.alias("role"),
        _clean(F.col("text")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(0)).alias("part"),
    )
    roles = (
        turns.where(~F.col("role").isin(CONTEXT))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_set("role")).alias("speakers"))
    )
    places = (
        turns.select("conv_id", "part")
        .distinct()
        .join(roles.withColumnRenamed("conv_id", "__c"), F.col("conv_id").eqNullSafe(F.col("__c")))
        .select(F.col("conv_id").alias("__id"), F.col("part").alias("__part"), "speakers")
    )
    gathered = turns.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    views = gathered.join(
        places, F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("part") == F.col("__part"))
    ).select("conv_id", "part", "turns", F.explode("speakers").alias("speaker"))

    def rendered(turn: Column) -> Column:
        return F.concat(_head(turn["role"], F.col("speaker")), turn["text"], F.lit(CLOSE))

    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )

    def added(state: Column, turn: Column) -> Column:
        after = state["at"] + F.length(rendered(turn))
        span = F.struct(
            (state["at"] + F.length(_head(turn["role"], F.col("speaker")))).alias("start"),
            after.alias("end"),
        )
        spans = F.when(
            turn["role"] == F.col("speaker"), F.concat(state["spans"], F.array(span))
        ).otherwise(state["spans"])
        return F.struct(after.alias("at"), spans.alias("spans"))

    return views.select(
        "conv_id",
        "speaker",
        "part",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", rendered), "").alias("rendered"),
        F.aggregate("turns", start, added)["spans"].alias("mask"),
    )
