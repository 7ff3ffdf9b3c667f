"""A Bloom filter of join keys, built by an aggregate and sent to every executor.

A key sets a few bits of one 64-bit word; the filter is the table of words that have any.
There are never more than ``words`` of them, 16 bytes each, however many keys there are, so
its size is known before anything runs. More than a few million keys fill it up: then it
lets more rows pass, and the join behind it still decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 MB at most; about one key in a hundred thousand passes by mistake with 100,000 keys,
#: one in fifty with 4 million.
WORDS = 1 << 20
_PROBES = 4


def _present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _word(keys: Sequence[str], words: int) -> Column:
    if words & (words - 1):
        raise ValueError(f"words must be a power of two, not {words}")
    # never NULL, unlike a remainder, so a join on it adds no filter below
    return F.xxhash64(*keys).bitwiseAND(F.lit(words - 1).cast("long"))


def _bits(keys: Sequence[str]) -> Column:
    """Bits of a key inside its word, from six bits each of a second hash."""
    spread = F.xxhash64(F.lit("bits"), *keys)
    one = F.lit(1).cast("long")
    bits = [
        F.call_function(
            "shiftleft", one, F.shiftright(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        )
        for i in range(_PROBES)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(frame: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """The filter of all keys in ``frame``: at most ``words`` rows of two numbers.

    Rows with a NULL among the keys equal nothing and leave no bits.
    """
    kept = frame.where(_present(keys))
    return (
        kept.select(_word(keys, words).alias("_word"), _bits(keys).alias("_bits"))
        .groupBy("_word")
        .agg(F.bit_or("_bits").alias("_bits"))
    )


def with_possible(
    frame: DataFrame, known: DataFrame, keys: Sequence[str], name: str, words: int = WORDS
) -> DataFrame:
    """Adds ``name``: false only where the keys are surely not in the filter.

    Rows are neither moved nor dropped. ``words`` is that of the filter.
    """
    hit = F.col("_bits").bitwiseAND(_bits(keys)) == _bits(keys)
    marked = frame.withColumn("_word", _word(keys, words)).join(F.broadcast(known), "_word", "left")
    return marked.withColumn(name, F.coalesce(_present(keys) & hit, F.lit(False))).drop(
        "_word", "_bits"
    )
