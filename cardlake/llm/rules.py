"""Quality rules: counts of words, lines and windows, and repetition by suffix arrays.

The suffixes of a text are sorted by prefix doubling, from packed first characters on;
only suffixes that still share their beginning are sorted again. Longest common prefixes
of neighbours follow from the permuted form: a value is one less than the value before it
in the text, unless the characters before the two suffixes differ, and only those
few are compared. The deepest longest-common-prefix interval of a suffix gives the
longest repeated string that starts there; the others of its intervals, and the strings
that a character on the left would lengthen, lie within such spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """What a document may not exceed, in code points and per cent."""

    least_words: int = 50
    repeat_words_percent: int = 50
    #: Shorter repeated strings are ordinary language.
    least_repeat: int = 40
    covered_percent: int = 30
    longest_repeat: int = 400


# ----------------------------------------------------------------------- suffix array


def suffix_order(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and at which of them ``least`` characters may be shared.

    ``codes`` are numbers from 1. The second array marks places of the order whose suffix
    may share as many characters with the one before; all others surely share fewer.
    """
    n = len(codes)
    bits = max(int(codes.max()).bit_length(), 1)
    width, key = 1, codes.astype(np.int64)
    while 2 * width * bits <= 63 and 2 * width <= least:
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = key[width:]
        key = (key << (width * bits)) | ahead
        width *= 2
    order = np.argsort(key, kind="stable")
    tied = np.append(False, key[order[1:]] == key[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(tied, 0, np.arange(n)))
    close = tied.copy()
    open_at = np.flatnonzero(tied | np.append(tied[1:], False))
    while len(open_at):
        suffixes = order[open_at]
        ahead = suffixes + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        pair = rank[suffixes] * (n + 1) + second
        turn = np.argsort(pair, kind="stable")
        suffixes, pair = suffixes[turn], pair[turn]
        order[open_at] = suffixes
        same = np.append(False, pair[1:] == pair[:-1])
        rank[suffixes] = np.maximum.accumulate(np.where(same, 0, open_at))
        width *= 2
        if width <= least:
            close[open_at] = same
        open_at = open_at[same | np.append(same[1:], False)]
    return order, close


def _shared(codes: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the common beginning of pairs of suffixes."""
    longest = np.zeros(len(one), np.int64)
    alive, window = np.arange(len(one)), 32
    padded = np.append(codes, np.zeros(1, codes.dtype))
    n = len(codes)
    while len(alive):
        going = []
        for part in np.array_split(alive, -(-len(alive) * window // 1_000_000)):
            steps = longest[part][:, None] + np.arange(window)
            a = padded[np.minimum(one[part][:, None] + steps, n)]
            b = padded[np.minimum(other[part][:, None] + steps, n)]
            apart = (a != b) | (a == 0)
            ended = apart.any(axis=1)
            longest[part] += np.where(ended, apart.argmax(axis=1), window)
            going.append(part[~ended])
        alive = np.concatenate(going)
        window = min(2 * window, 1 << 16)
    return longest


def repeated_from(codes: np.ndarray, least: int) -> np.ndarray:
    """At each place, the length of the longest string there that occurs elsewhere too.

    Lengths below ``least`` are given as 0. Occurrences may overlap.
    """
    n = len(codes)
    best = np.zeros(n, np.int64)
    if n <= least:
        return best
    order, close = suffix_order(codes, least)
    at = np.flatnonzero(close)
    if not len(at):
        return best
    before = np.full(n, -1, np.int64)
    before[order[at]] = order[at - 1]
    places = np.sort(order[at])
    partner = before[places]
    inner = (places > 0) & (partner > 0)
    first = ~inner | (codes[places - 1] != codes[partner - 1]) | (before[places - 1] < 0)
    known = np.flatnonzero(first)
    lengths = _shared(codes, places[known], partner[known])
    anchor = np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
    shared = lengths[np.cumsum(first) - 1] - (places - places[anchor])
    shared = np.where(shared >= least, shared, 0)
    best[places] = shared
    np.maximum.at(best, partner, shared)
    return best


def covered_spans(lengths: np.ndarray) -> np.ndarray:
    """The union of spans that start at each place, as rows of start and end."""
    n = len(lengths)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(lengths)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + lengths[at], -1)
    inside = np.concatenate([[False], np.cumsum(edge)[:n] > 0, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns.reshape(-1, 2)


def repetition(text: str, least: int) -> tuple[np.ndarray, int]:
    """Spans of code points covered by repeated strings, and the longest such string."""
    if len(text) <= least:
        return np.zeros((0, 2), np.int64), 0
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.unique(points, return_inverse=True)[1] + 1
    lengths = repeated_from(codes, least)
    return covered_spans(lengths), int(lengths.max(initial=0))


# ----------------------------------------------------------------------------- counts


def repeated_words(words: list[str]) -> int:
    """Words inside windows of three words that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs[:-1] * len(number) + ids[2:]
    _, place, count = np.unique(triples, return_inverse=True, return_counts=True)
    again = count[place] > 1
    hit = np.zeros(n, bool)
    for shift in range(3):
        hit[shift : shift + n - 2] |= again
    return int(hit.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


_FIELDS = [
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("n_covered", T.LongType()),
    ("longest_repeat", T.LongType()),
    ("repeats", T.ArrayType(T.ArrayType(T.LongType()))),
    ("base_failed", T.BooleanType()),
    ("kept", T.BooleanType()),
]


def _judgement(text: str | None, limits: Limits) -> tuple:
    text = text or ""
    words = _WORD.findall(text)
    n, repeats = len(words), repeated_words(words)
    failed = n < limits.least_words or 100 * repeats > limits.repeat_words_percent * n
    spans, longest = repetition(text, limits.least_repeat)
    covered = int((spans[:, 1] - spans[:, 0]).sum())
    good = 100 * covered <= limits.covered_percent * len(text) and longest <= limits.longest_repeat
    return (
        n, sum(map(len, words)), sum(map(text.count, _SYMBOLS)), repeated_lines(text), repeats,
        covered, longest, spans.tolist(), failed, not failed and good,
    )


def judged(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with counts, repeated spans and the verdict.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and
    ``base_failed`` come from words, lines and windows of three words. ``repeats`` are the
    [start, end) spans of code points that strings of at least ``least_repeat`` code points
    cover which occur twice or more in the text, ``n_covered`` their sum and
    ``longest_repeat`` the longest such string; ``kept`` holds where no limit is exceeded.
    The whole text counts; null and empty texts have no word, so they fail. Equal rows get
    equal results. Columns of ``docs`` with these names are replaced. No row is shuffled;
    a task holds one Arrow batch and the suffix array of one text, about 100 bytes for
    each of its characters.
    """
    kept = [c for c in docs.columns if c not in dict(_FIELDS)]
    at = kept.index(text_col)
    rows = docs.select(*kept)
    schema = T.StructType([*rows.schema, *[T.StructField(f, t) for f, t in _FIELDS]])
    kinds = [pa.int64()] * 7 + [pa.list_(pa.list_(pa.int64())), pa.bool_(), pa.bool_()]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            results = zip(*[_judgement(t, limits) for t in batch.column(at).to_pylist()])
            columns = [pa.array(v, k) for v, k in zip(results, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return rows.mapInArrow(found, schema)
