"""Target-distribution importance resampling with a head-tail vocabulary.

A document's features are its runs of one or more words, hashed into buckets by CRC32.
Frequent words are counted exactly over the whole corpus and broadcast with their CRC
state, from which the CRC of a longer run goes on without reading the word again;
frequent pairs are broadcast with their bucket. Words and pairs of the long tail take
their CRC directly. Either way a feature has the same bucket, so totals are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.shared import stored

BUCKETS = 10_000
#: Frequent words and pairs that are broadcast, and the longest of them, in bytes: at
#: most about 4 MB of each, whatever the corpus. Others only cost a CRC.
HEAD = 32_768
LONGEST = 64
#: Distinct words or pairs a task counts before it hands its counts on.
HELD = 100_000
LEAST_WORDS = 20
SHARE_PERCENT = 10
SEED = "2024"

# A-Z become a-z, every other ASCII byte that is no letter or digit a blank.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if chr(b).isalnum() or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class _Words(dict):
    """CRC state by word; one that is not in the head is computed and not kept."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class _Tail(dict):
    """Bucket by word; one that is not in the head is computed and not kept."""

    def __init__(self, head: dict[bytes, int], buckets: int):
        super().__init__(head)
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        return crc32(word) % self.buckets


@dataclass
class Vocabulary:
    """What tasks need to find the bucket of a feature.

    ``pairs`` hold buckets, from which no longer run can go on, so they are for width 2.
    """

    states: dict[bytes, int]
    pairs: dict[bytes, int]
    width: int
    buckets: int

    def __post_init__(self):
        self.states = _Words(self.states)
        self.single = _Tail({w: s % self.buckets for w, s in self.states.items()}, self.buckets)

    def __reduce__(self):
        # the derived tables are built again where it arrives
        return Vocabulary, (dict(self.states), self.pairs, self.width, self.buckets)

    def buckets_of(self, words: list[bytes]) -> np.ndarray:
        """The bucket of each run of 1 to ``width`` words, repeats included."""
        n = len(words)
        found = [np.fromiter(map(self.single.__getitem__, words), np.int64, n)]
        if self.width > 1 and n > 1:
            states = [self.states[w] for w in words]
            tails = [b" " + w for w in words]
            for size in range(2, min(self.width, n) + 1):
                if size == 2 and self.pairs:
                    known = [self.pairs.get(a + b) for a, b in zip(words, tails[1:])]
                    states = [
                        crc32(b, s) if k is None else k
                        for k, s, b in zip(known, states, tails[1:])
                    ]
                else:
                    states = [crc32(b, s) for s, b in zip(states, tails[size - 1 :])]
                found.append(np.array(states, np.int64) % self.buckets)
        return np.concatenate(found)


def _counts(docs: DataFrame, text_col: str, pairs: bool) -> DataFrame:
    """Exact counts of all words, or of all pairs of neighbouring words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                names=["term", "n"],
            )
            held.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                held.update(map(b" ".join, zip(words, words[1:])) if pairs else words)
                if len(held) > HELD:
                    yield handed_on()
        yield handed_on()

    rows = docs.select(text_col).mapInArrow(counted, "term binary, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def _head(docs: DataFrame, text_col: str, size: int, pairs: bool) -> list[bytes]:
    """The terms above some count, the smallest that leaves at most ``size`` short terms.

    Counts are compared by steps of an eighth of a power of two, so the search looks at
    a few hundred numbers. Terms just as frequent are in or out together.
    """
    counts = _counts(docs, text_col, pairs).where(F.octet_length("term") <= LONGEST)
    counts = stored(counts.withColumn("step", F.floor(8 * F.log2("n")).cast("int")), "counts")
    # at most 512 rows
    steps = sorted(counts.groupBy("step").count().collect(), reverse=True)
    least, found = None, 0
    for step, n in steps:
        found += n
        if found > size:
            break
        least = step
    if least is None:
        return []
    return [bytes(r[0]) for r in counts.where(F.col("step") >= least).select("term").collect()]


def vocabulary(
    docs: DataFrame, width: int = 1, buckets: int = BUCKETS, head: int = HEAD,
    text_col: str = "text",
) -> Vocabulary:
    """Frequent words of the whole table, and frequent pairs when ``width`` is above 1."""
    words = _head(docs, text_col, head, pairs=False)
    pairs = _head(docs, text_col, head, pairs=True) if width == 2 else []
    return Vocabulary(
        {w: crc32(w) for w in words}, {p: crc32(p) % buckets for p in pairs}, width, buckets
    )


def bucket_totals(
    docs: DataFrame, shipped: Broadcast, buckets: int = BUCKETS, text_col: str = "text"
) -> np.ndarray:
    """Features of all texts in each bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = shipped.value, np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(known.buckets_of(words_of(text.as_py())), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    # one row a bucket
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of both smoothed distributions, by bucket."""
    size = len(target)
    all_target, all_source = int(target.sum()), int(source.sum())
    return np.array(
        [
            math.floor(1000 * math.log(
                float(t + 1) * float(all_source + size) / (float(s + 1) * float(all_target + size))
            ))
            for t, s in zip(target.tolist(), source.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id alone; a null id is empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(
    docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = BUCKETS,
    text_col: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_features`` and ``weight``.

    The weight is the sum of the gains of all features of the whole text. Null and empty
    texts have none and weigh 0; equal texts weigh the same. An empty ``target`` or
    ``docs`` counts as 0 features. Columns of ``docs`` with these names are replaced.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(vocabulary(docs, width, buckets, text_col=text_col))
    gain = spark.sparkContext.broadcast(
        gains(
            bucket_totals(target, shipped, buckets, text_col),
            bucket_totals(docs, shipped, buckets, text_col),
        )
    )
    added = ["n_words", "n_features", "weight"]
    kept = [c for c in docs.columns if c not in added]
    at = kept.index(text_col)
    rows = docs.select(*kept)
    schema = T.StructType([*rows.schema, *[T.StructField(c, T.LongType()) for c in added]])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, by_bucket = shipped.value, gain.value
        for batch in batches:
            found = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column(at)):
                words = words_of(text.as_py())
                places = known.buckets_of(words)
                found[:, i] = len(words), len(places), by_bucket[places].sum()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, found)], names=schema.names
            )

    return rows.mapInArrow(summed, schema)


def drawn(
    weighed_docs: DataFrame, percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS,
    id_col: str = "doc_id", seed: str = SEED,
) -> DataFrame:
    """Adds ``score`` and ``rank``: 1, 2, 3... for the share with the highest scores.

    Of the documents with at least ``least_words`` words, ``percent`` per cent (rounded
    down) are drawn; ties go to the smaller id, a null id last, and rows alike in both
    in any order, each with a rank of its own. ``rank`` is null for all others. Columns of
    these names are replaced. Ranks come from ranges of the scores: rows are counted by
    range, and only ranges that reach into the share are numbered, each by itself.
    """
    spark = weighed_docs.sparkSession
    rows = weighed_docs.drop("score", "rank", "__place")
    score = F.col("weight") + noise(F.col(id_col), seed)
    rows = stored(
        rows.withColumns({"score": score, "__place": F.monotonically_increasing_id()}), "weighed"
    )
    best_first = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("__place")]
    able = rows.where(F.col("n_words") >= least_words).select("score", id_col, "__place")
    ranged = stored(
        able.repartitionByRange(*best_first).withColumn("__range", F.spark_partition_id()), "ranged"
    )
    # one row a range
    sizes = sorted(ranged.groupBy("__range").count().collect())
    wanted = sum(n for _, n in sizes) * percent // 100
    starts, before = [], 0
    for number, n in sizes:
        if before < wanted:
            starts.append((number, before))
        before += n
    offsets = spark.createDataFrame(starts, "__range int, __before long")
    order = Window.partitionBy("__range").orderBy(*best_first)
    ranks = (
        ranged.join(F.broadcast(offsets), "__range")
        .select("__place", (F.col("__before") + F.row_number().over(order)).alias("rank"))
        .where(F.col("rank") <= wanted)
    )
    return rows.join(stored(ranks, "ranks"), "__place", "left").drop("__place")
