"""Matching chargebacks with the presentments they refer to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake import functions as fn
from cardlake import schemas as S
from cardlake.operators import keyfilter
from cardlake.operators.joins import salted_join

ARN_PART = "arn_part"

_ARN = "_raw_arn"
_ARN_SPREAD = ["trace_id", "dpan", "v_rcnc"]
_POSSIBLE = "_possible"


def with_arn_part(presentments: DataFrame, parts: int) -> DataFrame:
    """Adds ``arn_part``, which spreads the presentments of one ARN over ``parts`` values.

    For storing, together with ``arn``, in buckets. Stored, it stays what it is; before,
    it follows from the row and its input partition.
    """
    row_salt = F.spark_partition_id().cast("bigint") + F.xxhash64(*_ARN_SPREAD) % parts
    return presentments.withColumn(ARN_PART, F.pmod(row_salt, F.lit(parts)).cast("int"))


def inherit_from_presentment(
    chargebacks: DataFrame,
    presentments: DataFrame,
    *,
    strip_keys: bool = False,
    salts: int = 1,
    arn_parts: int = 1,
) -> DataFrame:
    """Adds the inherited columns of every presentment with the chargeback's ARN.

    The chargeback's ARN is compared as delivered, while stored presentments
    carry a stripped one; ``strip_keys`` strips both. A missing or blank ARN
    matches nothing. An ARN shared by several presentments repeats the chargeback.

    Presentments stored in buckets of ``arn`` stay where they are, and only
    chargebacks are shuffled. With ``arn_parts`` the buckets are of ``arn`` and
    ``arn_part``, of so many parts, and each chargeback goes to every part: a
    join in buckets is not split at run time, so a dominant ARN is spread when stored.
    """
    key = fn.raw_arn()
    if strip_keys:
        key = F.when(key.isNotNull() & (fn.arn() != ""), fn.arn())
    parts = [ARN_PART] if arn_parts > 1 else []
    originals = presentments.select(
        F.col("arn").alias(_ARN), *parts, *S.INHERITED_COLUMNS, "trace_id"
    ).withColumnRenamed("trace_id", "_trace")
    keyed = chargebacks.withColumn(_ARN, key)
    if parts:
        copies = F.explode(F.sequence(F.lit(0), F.lit(arn_parts - 1)))
        keyed = keyed.withColumn(ARN_PART, copies)
    # Presentments are the larger side: they are spread, chargebacks copied.
    joined = salted_join(
        originals, keyed, [_ARN, *parts], salts=salts, spread=["_trace", "dpan", "v_rcnc"]
    )
    return joined.drop(_ARN, "_trace", *parts)


def match_fraud(presentments: DataFrame, chargebacks: DataFrame) -> DataFrame:
    """Every presentment with each fraud chargeback that matches it, or with none.

    The chargeback's columns come back prefixed with ``cb_``.
    """
    found = chargebacks.select(
        *[F.col(c).alias(f"cb_{c}") for c in chargebacks.columns]
    )
    same = [F.col(k) == F.col(f"cb_{k}") for k in S.MATCH_KEYS]
    return presentments.join(found, same, "left")


def fraud_counts(chargebacks: DataFrame) -> DataFrame:
    """The match keys with ``fraud_count``, the number of chargebacks that have them.

    A key has one row, so presentments that meet it are never multiplied, and however
    many chargebacks repeat a key, map-side partial counts carry them. A NULL matches
    nothing.
    """
    present = F.lit(True)
    for key in S.MATCH_KEYS:
        present = present & F.col(key).isNotNull()
    return (
        chargebacks.where(present)
        .groupBy(*S.MATCH_KEYS)
        .agg(F.count(F.lit(1)).alias("fraud_count"))
    )


def count_fraud(
    presentments: DataFrame,
    chargebacks: DataFrame,
    by: Sequence[str],
    *,
    words: int = keyfilter.WORDS,
) -> DataFrame:
    """Presentments counted by ``by`` and match keys, with their ``fraud_count``.

    ``n_presented`` says how many presentments a row stands for. Those that a filter
    of the chargebacks' keys rules out are counted by ``by`` alone, before any
    shuffle: their keys are NULL, as is ``fraud_count``. So are copies of a possible match,
    so a dominant key shrinks to a row per value of ``by`` inside each task. Only
    possible matches are shuffled once more, to meet the counts.
    """
    counts = fraud_counts(chargebacks)
    # True of all counts; it keeps both uses of them alike, so they are computed once.
    known = keyfilter.key_filter(counts.where("fraud_count > 0"), S.MATCH_KEYS, words)
    marked = keyfilter.with_possible(presentments, known, S.MATCH_KEYS, _POSSIBLE, words)
    keys = {k: F.when(F.col(_POSSIBLE), F.col(k)) for k in S.MATCH_KEYS}
    # Both branches test results of the aggregate, the same ones: a filter on a grouping
    # column would move below the shuffle, an unused count would be left out there, and
    # the presentments would be read once for each branch.
    counted = (
        marked.withColumns(keys)
        .groupBy(*by, *S.MATCH_KEYS)
        .agg(F.count(F.lit(1)).alias("n_presented"), F.bool_or(_POSSIBLE).alias(_POSSIBLE))
    )
    counted = counted.where("n_presented > 0")
    ruled_out = counted.where(~F.col(_POSSIBLE)).drop(_POSSIBLE)
    possible = counted.where(F.col(_POSSIBLE)).drop(_POSSIBLE)
    matched = possible.join(counts, S.MATCH_KEYS, "left")
    return matched.unionByName(
        ruled_out.withColumn("fraud_count", F.lit(None).cast("long"))
    ).select(*by, *S.MATCH_KEYS, "n_presented", "fraud_count")


def counted_pairs(
    presentments: DataFrame, chargebacks: DataFrame, own: Sequence[str], other: Sequence[str]
) -> DataFrame:
    """The pairs of ``match_fraud`` by their columns, with ``n_pairs``, how often each occurs.

    Equal rows of either side are counted before they meet, so n copies of a
    presentment and m of a chargeback make one row with n * m, not as many rows.
    """
    left = presentments.groupBy(*{*own, *S.MATCH_KEYS}).agg(F.count(F.lit(1)).alias("_n"))
    right = chargebacks.groupBy(*{*other, *S.MATCH_KEYS}).agg(F.count(F.lit(1)).alias("_m"))
    met = match_fraud(left, right)
    # different rows may agree in the chosen columns
    return met.groupBy(*own, *[f"cb_{c}" for c in other]).agg(
        F.sum(F.col("_n") * F.coalesce("cb__m", F.lit(1))).alias("n_pairs")
    )
