"""Quality classifier: neighbours vote in a latent-semantic space.

A text becomes counts of hashed words, of pairs of neighbouring character classes, and
of repetitions. Weighted by rarity and projected on the leading singular directions of
a labelled sample, it is a short vector. The labelled vectors are broadcast; every
document's cosine with all of them is one block of a matrix product, and the labels of
its nearest neighbours vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that vote, at most. The vectors broadcast take 4 * (rows + terms) *
#: dimensions bytes, about 0.8 MB, whatever the size of the corpus.
MAX_LABELLED = 2048
DIMENSIONS = 48
NEIGHBOURS = 25
#: Documents in a block of the matrix product.
BLOCK = 512
THRESHOLD = 0.3

WORD_TERMS = 1024
_MARKS = b".,;:!?'\"()[]{}<>-_/#$%&*|=+@~^`\\"
_CLASSES = 36
_CLASS = np.zeros(256, np.int32)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        4 + _MARKS[:-1].find(bytes([_b])) if _b in _MARKS[:-1]
        else 0 if _b >= 128 or "a" <= _c <= "z"
        else 1 if "A" <= _c <= "Z"
        else 2 if "0" <= _c <= "9"
        else 3 if _b in b" \t"
        else 35
    )
PAIR_TERMS = _CLASSES * _CLASSES
REPEAT_TERMS = 4
TERMS = WORD_TERMS + PAIR_TERMS + REPEAT_TERMS
#: Length of the part that words, character pairs and repetitions have in a vector.
_PARTS = [
    (0, WORD_TERMS, 0.3),
    (WORD_TERMS, WORD_TERMS + PAIR_TERMS, 1.0),
    (WORD_TERMS + PAIR_TERMS, TERMS, 1.0),
]


def counts_of(text: str | None) -> np.ndarray:
    """Term frequencies of the whole text; zeros if it is null or empty."""
    out = np.zeros(TERMS, np.float32)
    raw = (text or "").encode()
    if not raw:
        return out
    words = raw.split()
    if words:
        ids = np.fromiter(map(crc32, words), np.int64, len(words)) % WORD_TERMS
        out[:WORD_TERMS] = np.bincount(ids, minlength=WORD_TERMS) / len(words)
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    pairs = np.bincount(kinds[:-1] * _CLASSES + kinds[1:], minlength=PAIR_TERMS)
    out[WORD_TERMS:-REPEAT_TERMS] = pairs / len(raw)
    lines = raw.splitlines()
    if words:
        out[-4] = sum(map(eq, words, words[1:])) / len(words)
        out[-3] = 1 - len(set(words)) / len(words)
        out[-2] = sum(map(eq, words, words[2:])) / len(words)
    if lines:
        out[-1] = 1 - len(set(lines)) / len(lines)
    return out


@dataclass
class Voters:
    """Labelled vectors and the projection that leads to them."""

    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    @classmethod
    def fitted(
        cls,
        counts: np.ndarray,
        labels: np.ndarray,
        dimensions: int = DIMENSIONS,
        neighbours: int = NEIGHBOURS,
    ) -> Voters:
        seen = (counts > 0).sum(0)
        rarity = (np.log((1 + len(counts)) / (1 + seen)) + 1).astype(np.float32)
        weighted = _weighted(counts, rarity)
        directions = _leading(weighted, dimensions)
        return cls(
            rarity, directions, _unit(weighted @ directions), labels.astype(np.float32), neighbours
        )

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest voters, weighted by cosine."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        likeness = _unit(_weighted(counts, self.rarity) @ self.directions) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(likeness, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(likeness, near, 1), 1e-6).astype(np.float64) ** 4
        votes = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.where(counts.any(axis=1), votes, self.labels.mean())


def _leading(rows: np.ndarray, dimensions: int, rounds: int = 12) -> np.ndarray:
    """Leading right singular directions by subspace iteration; needs little memory."""
    start = np.random.default_rng(1).standard_normal((rows.shape[1], dimensions + 16))
    found = np.linalg.qr(start.astype(np.float32))[0]
    for _ in range(rounds):
        found = np.linalg.qr(rows.T @ (rows @ found))[0]
    _, turn = np.linalg.eigh((product := rows @ found).T @ product)
    return np.ascontiguousarray((found @ turn[:, ::-1])[:, :dimensions])


def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    out = np.sqrt(counts) * rarity
    for first, after, length in _PARTS[:2]:
        part = out[:, first:after]
        part *= length / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    first, after, length = _PARTS[2]
    out[:, first:after] = counts[:, first:after] * length
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def is_held_out(doc_id: Column) -> Column:
    """A fifth of all ids, kept from training; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def trained(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Voters:
    """Voters from at most ``max_labelled`` labelled documents.

    The sample are the labels with the smallest hashes of their ids, so it is the
    same on every run and spread over all documents; held-out ids are left out. Null
    ids and labels are skipped; of several labels of an id the smallest counts, of
    several texts the one with the smallest hash. Documents without a label are not read
    into memory.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts_of(t).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), *batch.columns[1:]],
                names=["counts", "quality", "place"],
            )

    # at most max_labelled rows, brought into one order
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", F.col("quality").cast("int").alias("quality"))
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select("text", "quality", F.xxhash64("doc_id").alias("place"))
        .mapInArrow(counted, "counts binary, quality int, place long")
        .collect()
    )
    rows.sort(key=lambda r: r[2])
    if not rows:
        empty = np.zeros((0, TERMS), np.float32)
        return Voters(np.ones(TERMS, np.float32), np.eye(TERMS, 1), empty, np.zeros(0), 1)
    labels_found = np.array([r[1] for r in rows])
    counts = np.empty((len(rows), TERMS), np.float32)
    while rows:  # each is given up once copied
        counts[len(rows) - 1] = np.frombuffer(rows[-1][0], np.float32)
        rows.pop()
    return Voters.fitted(counts, labels_found)


def scored(
    docs: DataFrame, voters: Voters, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1) and ``predicted``.

    The whole text counts. Null and empty texts get the labels' mean; without any labelled
    row every score is 0.5. Equal texts have equal scores. Columns of these names in
    ``docs`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    at = kept.index(text_col)
    frame = docs.select(*kept)
    shipped = docs.sparkSession.sparkContext.broadcast(voters)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                block = batch.slice(first, BLOCK)
                counts = np.stack([counts_of(t) for t in block.column(at).to_pylist()])
                score = shipped.value.scores(counts)
                yield pa.RecordBatch.from_arrays(
                    [*block.columns, pa.array(np.clip(score, 0.0, 1.0), pa.float64())],
                    names=[*block.schema.names, "score"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    return frame.mapInArrow(voted, f"{fields}, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
