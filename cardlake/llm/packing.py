"""Best-fit decreasing packing of token pieces into sequences.

Best fit in order of falling length depends on nothing but how many pieces have
which length. So the pieces are counted by length (a bounded table), the packing
is computed for the counts, and every piece finds its place from its rank among
the pieces of its length. No piece passes through the driver.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.shared import stored

CAPACITY = 1024
END_ID = 2
#: Distinct words whose ids a worker remembers; about 200 bytes each. Later words are
#: encoded when they occur.
REMEMBERED = 1_000_000
#: Texts of one step, and words of one call to the tokenizer.
STEP, CALL = 128, 64

#: Where a blank is not the start of a new pre-token.
_UNEVEN_BLANK = re.compile(r" (?:\s|\Z)")


class _Known(dict):
    """Ids by word. A word that is not known yet stands for itself and is noted."""

    def __init__(self):
        super().__init__()
        self.missed: set[str] = set()

    def __missing__(self, word: str) -> str:
        self.missed.add(word)
        return word


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    A byte-level pre-token never spans a blank that is followed by a visible
    character, so a text's ids are those of its words, each with the blank before it.
    Words are remembered; new ones of several texts are encoded at once, set apart by
    a special token. Texts with other white space beside a blank, and texts that
    spell a special token, which then stands for itself, are encoded whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parting = Tokenizer.from_file(path)
        specials = self.parting.get_added_tokens_decoder()
        self.mark_id = min(specials)
        self.mark = specials[self.mark_id].content
        self.special = re.compile("|".join(re.escape(t.content) for t in specials.values()))
        self.remembered = remembered
        self.known = _Known()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of words, each with a blank before it."""
        between = f"{self.mark} "
        calls = [words[j : j + CALL] for j in range(0, len(words), CALL)]
        found = self.parting.encode_batch_fast(
            [" " + between.join(c) for c in calls], add_special_tokens=False
        )
        for some, encoding in zip(calls, found, strict=True):
            ids = np.array(encoding.ids, "<u4")
            ends = [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
            raw, start = ids.tobytes(), 0
            for word, end in zip(some, ends, strict=True):
                self.known[word] = raw[4 * start : 4 * end]
                start = end + 1

    def ids(self, texts: list[str]) -> list[bytes]:
        known, rows = self.known, []
        for text in texts:
            words = text.split(" ")
            if _UNEVEN_BLANK.search(text) or self.special.search(text):
                rows.append([self._whole(text)])
            else:
                first = words.pop(0)
                found = [self._whole(first)] if first else []
                found.extend(map(known.__getitem__, words))
                rows.append(found)
        new = list(known.missed)
        known.missed.clear()
        self._learn(new)
        out = [b"".join([v if v.__class__ is bytes else known[v] for v in row]) for row in rows]
        if len(known) > self.remembered:
            for word in new:
                del known[word]
        return out


@cache
def _encoder(path: str, remembered: int) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path, remembered)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Token pieces of every row: id, piece, start, length, ids (binary).

    ``ids`` holds little-endian unsigned 32-bit token ids, each document's last
    one being ``end_id``. Null and empty texts give one piece with that id alone.
    Documents of at most ``capacity`` tokens are never cut. Rows with equal ids
    each give their own pieces. ``remembered`` words are kept by each worker, also
    between tasks: fewer need less memory and more time. Other columns of ``docs`` are not returned.
    """
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.schema[id_col].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, remembered)
        for batch in batches:
            for first in range(0, batch.num_rows, STEP):
                yield cut_up(encoder, batch.slice(first, STEP))

    def cut_up(encoder: Encoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        take, piece, start, length, ids = [], [], [], [], []
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for row, raw in enumerate(encoder.ids(texts)):
            raw += end
            for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                take.append(row)
                piece.append(k)
                start.append(s)
                length.append(n)
                ids.append(raw[4 * s : 4 * (s + n)])
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(take, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=["doc", "piece", "start", "length", "ids"],
        )

    return (
        docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
        .mapInArrow(encoded, f"doc {id_type}, piece int, start long, length long, ids binary")
        .withColumnRenamed("doc", id_col)
    )


class CapacityTree:
    """Segment tree over capacities: is there an open bin with at least so much left?"""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.bins = [0] * (2 * self.size)

    def add(self, left: int, count: int) -> None:
        node = self.size + left
        while node:
            self.bins[node] += count
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """Smallest capacity of at least ``need`` that an open bin has left."""
        node = self.size + need
        if self.bins[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.bins[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node + (not self.bins[2 * node])
                return node - self.size
            node >>= 1
        return None


def best_fit(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing for ``counts`` pieces of each length.

    Returns runs (length, first rank, first bin, pieces a bin, offset) sorted by
    length and rank, and the number of bins. Equal bins are handled together: a
    bin that takes a piece is at once the tightest for the next of its length, as
    long as it fits.
    """
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    runs, bins = [], 0

    def put_back(left: int, first: int, count: int) -> None:
        if left and count:
            open_bins.setdefault(left, []).append((first, count))
            tree.add(left, count)

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            left = tree.tightest(length)
            if left is None:
                left, first = capacity, bins
                available = -(-(total - rank) // (capacity // length))
                bins += available
            else:
                first, available = open_bins[left].pop()
                tree.add(left, -available)
            each = left // length
            used = min(available, -(-(total - rank) // each))
            placed = min(used * each, total - rank)
            runs.append((length, rank, first, each, capacity - left))
            full, rest = divmod(placed, each)
            put_back(left - each * length, first, full)
            put_back(left - rest * length, first + full, 1 if rest else 0)
            put_back(left, first + used, available - used)
            rank += placed
    return np.array(sorted(runs), np.int64).reshape(-1, 5), bins


def packed(pieces_frame: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; all other columns stay.

    Every row needs a ``length`` from 1 to ``capacity``; other lengths and nulls
    raise an error. Sequences are gapless from offset 0. Rows are counted by input
    task and length first; the counts, not the rows, give each task the ranks of its
    rows, so neither a frequent length nor the driver ever holds a group of rows.
    Columns named ``sequence_id`` or ``offset`` are replaced.
    """
    kept = [c for c in pieces_frame.columns if c not in ("sequence_id", "offset")]
    # written first: encoding and ranking then never hold two workers of one task
    frame = stored(pieces_frame.select(*kept), "unranked")
    at = kept.index("length")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False)
            if len(lengths) and not (lengths.min() >= 1 and lengths.max() <= capacity):
                raise ValueError(f"lengths must lie between 1 and {capacity}")
            lengths = lengths.astype(np.int64)
            order = np.argsort(lengths, kind="stable")
            first = np.searchsorted(lengths[order], lengths[order])
            rank = np.empty(len(lengths), np.int64)
            rank[order] = np.arange(len(lengths)) - first
            rank += seen[lengths]
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), part, np.int32)), pa.array(rank)],
                names=[*batch.schema.names, "__part", "__rank"],
            )

    rows = stored(frame.mapInArrow(ranked, f"{fields}, __part int, __rank long"), "pieces")
    counts = rows.groupBy("__part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("__part")
    bases = counts.select(
        F.col("__part").alias("__p"),
        F.col("length").alias("__l"),
        (F.sum("n").over(earlier) - F.col("n")).alias("__base"),
    )
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    runs, _ = best_fit(histogram, capacity)
    shipped = frame.sparkSession.sparkContext.broadcast(runs)
    width = len(kept)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        by_length = [table[table[:, 0] == n] for n in range(capacity + 1)]
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(width).to_numpy() + batch.column(width + 1).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(lengths):
                mine = np.flatnonzero(lengths == n)
                own = by_length[n]
                run = own[np.searchsorted(own[:, 1], rank[mine], "right") - 1]
                step = rank[mine] - run[:, 1]
                sequence[mine] = run[:, 2] + step // run[:, 3]
                offset[mine] = run[:, 4] + step % run[:, 3] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:width], "sequence_id", "offset"],
            )

    joined = rows.join(
        bases, (rows["__part"] == bases["__p"]) & (rows["length"] == bases["__l"])
    ).select(*[rows[c] for c in kept], "__rank", "__base")
    return joined.mapInArrow(placed, f"{fields}, sequence_id long, offset long")
