"""Benchmark decontamination by one Aho-Corasick automaton.

Test items and texts are normalised alike: A-Z in lower case, words of ASCII
letters, digits and all characters beyond ASCII. The automaton holds every
window of ``window`` consecutive item words (a shorter item is one window).
Each text is scanned once; ends of matches are mapped back to words, and words
to character offsets of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cardlake.llm.shared import stored

WINDOW = 13
#: Bytes of item text in one automaton. Its nodes need
#: about 100 bytes for each byte of text and window word.
MAX_ITEM_BYTES = 4_000_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_OTHER = bytes(b for b in range(128) if not _WORD.match(bytes([b]).lower()))
_BLANKED = bytes.maketrans(_OTHER, b" " * len(_OTHER))


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8."""
    return (text or "").encode().lower().translate(_BLANKED).split()


def windows_of(words: list[bytes], window: int) -> list[list[bytes]]:
    if len(words) <= window:
        return [words] if words else []
    return [words[i : i + window] for i in range(len(words) - window + 1)]


def _key(words: list[bytes]) -> str:
    return b"".join((b" ", b" ".join(words), b" ")).decode("latin-1")


def automaton_of(items: list[tuple[int, str | None]], window: int = WINDOW):
    """Automaton of (words in the window, ids of its items)."""
    owners: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        for words in windows_of(words_of(text), window):
            owners.setdefault(_key(words), (len(words), set()))[1].add(item_id)
    automaton = ahocorasick.Automaton()
    for key, value in owners.items():
        automaton.add_word(key, value)
    if owners:
        automaton.make_automaton()
    return automaton


def _char_spans(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as character offsets of the original text."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    spans = []
    for first, after in _runs(hit):
        start = len(raw[: places[first][0]].decode())
        spans.append(
            {"start": start, "end": start + len(raw[places[first][0] : places[after - 1][1]].decode())}
        )
    return spans


def occurring(automaton, words: list[bytes]) -> tuple[list[list[int]], list]:
    """Runs of hit words (first, one after the last) and the items that occur."""
    if not words or not len(automaton):
        return [], []
    line = _key(words)
    found = list(automaton.iter(line))
    if not found:
        return [], []
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    after = np.searchsorted(blanks, [end for end, _ in found])
    lengths = np.array([n for _, (n, _) in found])
    items = sorted(set().union(*(owners for _, (_, owners) in found)))
    return _runs(_marked(len(words), after - lengths, after)).tolist(), items


def _marked(n_words: int, firsts, afters) -> np.ndarray:
    """Which words lie inside a run."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, afters, -1)
    return np.cumsum(change[:-1]) > 0


def _runs(hit: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return np.stack([edges[::2], edges[1::2]], axis=1)


def judged(text: str | None, words: list[bytes], runs: list) -> tuple[int, int, list[dict]]:
    """Words, hit words, and spans of hit words in the text. Runs may overlap."""
    if not len(runs):
        return len(words), 0, []
    firsts, afters = np.array(runs, np.int64).T
    hit = _marked(len(words), firsts, afters)
    return len(words), int(hit.sum()), _char_spans(text, hit)


def is_contaminated(n_hit, n_words):
    """At least one word in 20 lies inside a test passage. For numbers and columns."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


#: The automaton this worker built last, by the name of its part of the items.
_KEPT: dict = {}


def _kept_automaton(name: str, shipped, window: int):
    """The automaton of a part of the items, built once in each worker.

    A worker holds one at a time, whatever tasks it gets.
    """
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = automaton_of(shipped.value, window)
    return _KEPT[name]


def _parts(items: DataFrame, max_item_bytes: int) -> list[DataFrame]:
    """The items in parts of at most ``max_item_bytes`` bytes of text.

    Parts are made by hash, more of them until each is small enough. An item that alone
    is longer is a part of its own.
    """
    named = items.select("item_id", "text").where("text is not null")
    size = F.octet_length("text")
    total = named.agg(F.sum(size)).first()[0] or 0
    if total <= max_item_bytes:
        return [named]
    row = F.xxhash64("item_id", "text")
    named = named.distinct()
    long_rows = named.where(size > max_item_bytes).select(row.alias("row")).distinct()
    parts = [named.where((size > max_item_bytes) & (row == r.row)) for r in long_rows.collect()]
    short, n = named.where(size <= max_item_bytes), 1
    while True:
        sums = short.groupBy(F.pmod(row, F.lit(n))).agg(F.sum(size).alias("size"))
        if (sums.agg(F.max("size")).first()[0] or 0) <= max_item_bytes:
            break
        n *= 2
    return parts + [short.where(F.pmod(row, F.lit(n)) == i) for i in range(n)]


def _shipped(items: DataFrame):
    """A part of the items as a broadcast variable, and a name for its automaton."""
    rows = [(r[0], r[1]) for r in items.collect()]
    if any(i is None and words_of(t) for i, t in rows):
        raise ValueError("a test item with words needs an item_id")
    return uuid4().hex, items.sparkSession.sparkContext.broadcast(rows)


_RUNS = "array<array<int>>"


def _hits(docs: DataFrame, items: list[DataFrame], window: int, text_col: str) -> DataFrame:
    """Hit texts, each once: key, runs of hit words, items, verdict.

    One pass over the texts for each part of the items, each written before the next, so
    that a worker never holds more than one automaton.
    """
    item_field = items[0].schema["item_id"].dataType
    item_type, item_kind = item_field.simpleString(), pa.list_(to_arrow_type(item_field))
    texts = docs.select(_text_key(text_col).alias("key"), F.col(text_col).alias("text"))

    def one_pass(name: str, shipped):
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _kept_automaton(name, shipped, window)
            for batch in batches:
                out = []
                for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    words = words_of(text)
                    runs, owners = occurring(automaton, words)
                    if runs:
                        out.append((key, len(words), runs, owners))
                columns = list(zip(*out, strict=True)) or [[]] * 4
                kinds = [pa.string(), pa.int64(), pa.list_(pa.list_(pa.int32())), item_kind]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["key", "n_words", "runs", "items"],
                )

        schema = f"key string, n_words long, runs {_RUNS}, items array<{item_type}>"
        return texts.mapInArrow(found, schema).dropDuplicates(["key"])

    passes = []
    for part in items:
        name, shipped = _shipped(part)
        passes.append(stored(one_pass(name, shipped), "item-hits"))
        shipped.unpersist()
    merged = reduce(DataFrame.unionByName, passes).groupBy("key", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    n_hit = F.aggregate(
        "runs",
        start,
        lambda state, run: F.struct(
            (state["n"] + F.greatest(run[1] - F.greatest(run[0], state["reach"]), F.lit(0))).alias("n"),
            F.greatest(state["reach"], run[1]).alias("reach"),
        ),
    )["n"]
    verdict = is_contaminated(n_hit, F.col("n_words")).alias("contaminated")
    return stored(merged.select("key", "runs", "items", verdict), "hit-texts")


def _text_key(text_col: str):
    return F.sha2(F.col(text_col).cast("binary"), 256)


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """Per row of ``docs``: words, hit words, items found, hit spans, verdict.

    ``items`` has ``item_id`` and ``text``. Test sets do not grow with the corpus: up to
    ``max_item_bytes`` of text they are one broadcast and one automaton, and nothing is
    shuffled. A larger set is cut into parts below that size (an item that alone is longer
    is a part of its own); the texts are read once for each, and what the parts find is
    merged by text, with the same result.

    Null or empty texts and texts without words have 0 words and are clean. Null
    items have no windows; a null ``item_id`` is left out of the found items'
    list only if its text has no words, otherwise it is refused. Equal windows of
    several items count for each of them. Rows with equal ids stay separate rows.
    Other columns of ``docs`` are not returned.
    """
    parts = _parts(items, max_item_bytes)
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema["item_id"].dataType.simpleString()
    item_kind = pa.list_(to_arrow_type(items.schema["item_id"].dataType))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    if len(parts) == 1:
        name, shipped = _shipped(parts[0])
    else:
        name = None
        hits = _hits(docs, parts, window, text_col).drop("contaminated")
        rows = rows.withColumn("key", _text_key("text")).join(hits, "key", "left")
        rows = rows.select("doc", "text", "runs", "items")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _kept_automaton(name, shipped, window) if name else None
        for batch in batches:
            out = []
            for text, *known in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                words = words_of(text)
                runs, owners = known if automaton is None else occurring(automaton, words)
                out.append((*judged(text, words, runs or []), owners or []))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[3] for o in out], item_kind),
                    pa.array(
                        [o[2] for o in out],
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                    ),
                ],
                names=["doc", "n_words", "n_hit", "items", "spans"],
            )

    return (
        rows.mapInArrow(
            scanned,
            f"doc {id_type}, n_words long, n_hit long, items array<{item_type}>, "
            "spans array<struct<start:long,end:long>>",
        )
        .withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))
        .withColumnRenamed("doc", id_col)
    )


def without_contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Judges as ``decontaminated`` does: row by row, without a join, while the items are one
    part; otherwise by the keys of contaminated texts.
    """
    parts = _parts(items, max_item_bytes)
    if len(parts) > 1:
        bad = _hits(docs, parts, window, text_col).where("contaminated").select("key")
        rows = docs.select(F.struct("*").alias("row"), _text_key(text_col).alias("key"))
        return rows.join(bad, "key", "left_anti").select("row.*")
    name, shipped = _shipped(parts[0])
    at = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _kept_automaton(name, shipped, window)
        for batch in batches:
            clean = []
            for text in batch.column(at).to_pylist():
                words = words_of(text)
                n_words, n_hit, _ = judged(text, words, occurring(automaton, words)[0])
                clean.append(not is_contaminated(n_hit, n_words))
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
