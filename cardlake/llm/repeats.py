"""Repeated byte strings by suffix order, Burrows-Wheeler transform and interval expansion.

A byte string of ``least`` bytes that also starts earlier is a repeat. To find repeats
on many machines, every string of that length is assigned to the smallest hash among its
32-byte grams (leftmost if tied), so equal strings have the same gram at the same place:

1. Neighbouring starts with the same gram are one stretch. Equal stretches are repeats as
   a whole, found by their hashes: within a batch first, then after a shuffle by gram.
2. Grams that still have several different stretches get their bytes. Stretches are
   concatenated, sorted by suffix, and the transform's intervals are extended to the left,
   one level of common prefix after another, up to the minimum length. Suffixes with no
   boundary between them by then share that many bytes; all but the first start are repeats.
3. A gram with more stretches than one task should hold deals out its single strings
   by their hashes instead.

No task gets all stretches of a gram that many documents share: grams of crowded buckets of a
histogram are shuffled with their content, and those that need bytes are counted, so that
strings of hot ones are dealt out before any shuffle by gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.shared import stored

LEAST = 100
GRAM = 32
#: Bytes whose suffixes are sorted at once.
CHUNK = 2_000_000
#: Bytes of stretches of one gram beyond which its strings are dealt out.
HOT = 4_000_000
#: Buckets of grams that are counted, and how many rows more than the mean (and at least)
#: make one crowded. Fewer than BUCKETS / CROWD can be.
BUCKETS = 1 << 16
CROWD = 8
CROWD_ROWS = 1000
#: Stretches whose strings are hashed at once.
_DEALT = 2000
#: Starts of a text that are handled at once.
_PIECE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOW = np.uint64((1 << 20) - 1)
_LOWEST = -(2**63)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 1 << 19), _powers(_INVERSE, 1 << 19)


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` bytes."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    out = (sums[gram:] - sums[:-gram]) * _DOWN[: n - gram + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def stretches(raw: bytes, least: int = LEAST, gram: int = GRAM) -> Iterator[tuple]:
    """Arrays (gram hash, first start, last start, gram place) covering all starts."""
    data = np.frombuffer(raw, np.uint8)
    for first in range(0, len(data) - least + 1, _PIECE):
        part = data[first : first + _PIECE + least - 1]
        hashes = gram_hashes(part, gram)
        keyed = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        place = (_smallest(keyed, least - gram + 1) & _LOW).astype(np.int64)
        begin = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(begin[1:], len(place)) - 1
        yield hashes[place[begin]], first + begin, first + last, first + place[begin]


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` codes, by doubling."""
    n = len(codes)
    base = np.uint64(codes.max() + 2)
    padded = np.concatenate([codes.astype(np.uint64) + np.uint64(1), np.zeros(2, np.uint64)])
    key = (padded[:n] * base + padded[1 : n + 1]) * base + padded[2 : n + 2]
    done = 3
    while True:
        order = np.argsort(key)
        steps = np.append(False, key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(steps).astype(np.uint64) + np.uint64(1)
        if done >= depth or int(rank.max()) == n:
            return order
        shifted = np.zeros(n, np.uint64)
        shifted[: n - done] = rank[done:]
        key = rank * np.uint64(n + 1) + shifted
        done *= 2


def prefix_boundaries(codes: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Where neighbours in suffix order share fewer than ``least`` codes.

    Breadth first: intervals of suffixes with a common prefix of ``level`` codes are
    extended to the left by each code of the transform within them. An interval whose right
    boundary is new has that boundary at this level and goes on; others do not.
    """
    n = len(codes)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    to_left = place[order - 1]
    to_right = np.empty(n, np.int64)
    to_right[to_left] = np.arange(n)
    head = codes[order]
    known = np.zeros(n + 1, bool)
    known[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        if not len(low):
            break
        size = high - low
        total = int(size.sum())
        if total * 16 > n:
            owner = np.full(n, -1, np.int32)
            inside = np.repeat(low - np.cumsum(size) + size, size) + np.arange(total)
            owner[inside] = np.repeat(np.arange(len(low), dtype=np.int32), size)
            mine = owner[to_right]
            target = np.flatnonzero(mine >= 0)
            mine = mine[target]
        else:
            inside = np.repeat(low - np.cumsum(size) + size, size) + np.arange(total)
            target = to_left[inside]
            sort = np.argsort(target)
            target = target[sort]
            mine = np.repeat(np.arange(len(low), dtype=np.int32), size)[sort]
        # images of an interval under one code are contiguous
        new = np.append(True, (mine[1:] != mine[:-1]) | (head[target[1:]] != head[target[:-1]]))
        begin = np.flatnonzero(new)
        low, high = target[begin], target[np.append(begin[1:], len(target)) - 1] + 1
        fresh = ~known[high]
        low, high = low[fresh], high[fresh]
        known[high] = True
    return known[:n]


def repeated_starts(parts: list[bytes], least: int = LEAST) -> list[np.ndarray]:
    """For each part the starts whose ``least`` bytes also start earlier in the list."""
    lengths = np.array([len(p) for p in parts])
    firsts = np.cumsum(lengths + 1) - lengths - 1
    codes = np.empty(int(lengths.sum()) + len(parts), np.int64)
    body = np.ones(len(codes), bool)
    body[firsts + lengths] = False
    # ends differ from each other, so no common prefix reaches over one
    codes[~body] = np.arange(len(parts))
    codes[body] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + len(parts)
    order = suffix_order(codes, int(lengths.max()) + 1)
    bounds = prefix_boundaries(codes, order, least)
    bounds[0] = True
    begin = np.flatnonzero(bounds)
    earliest = np.minimum.reduceat(order, begin)
    repeat = np.ones(len(codes), bool)
    repeat[earliest] = False
    return [np.flatnonzero(repeat[f : f + n]) for f, n in zip(firsts, lengths, strict=True)]


_SPAN = [("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]


def _spans_of(doc, mark, start, end) -> pa.RecordBatch:
    """Spans sorted by row, touching ones merged."""
    order = np.lexsort([end, start, mark, doc])
    doc, mark, start, end = doc[order], mark[order], start[order], end[order]
    if len(doc):
        row = np.append(True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]))
        row_no = np.cumsum(row)
        reach = np.maximum.accumulate(end + row_no * (1 << 44)) - row_no * (1 << 44)
        new = row | np.append(True, start[1:] > reach[:-1])
        begin = np.flatnonzero(new)
        doc, mark, start = doc[begin], mark[begin], start[begin]
        end = reach[np.append(begin[1:], len(reach)) - 1]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, (_, t) in zip((doc, mark, start, end), _SPAN, strict=True)],
        names=[n for n, _ in _SPAN],
    )


def _first_of_runs(gram, content, doc, mark, place) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of gram, content, doc, mark, place; and which are first of a content."""
    order = np.lexsort([place, mark, doc, content, gram])
    g, c = gram[order], content[order]
    return order, np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1]))[: len(order)]


_STRETCH = "gram long, content long, doc long, mark long, place long, start long, end long"


def _anchored(rows: DataFrame, least: int) -> DataFrame:
    """Stretches (gram set) and, with a null gram, spans that repeat within a batch.

    ``place`` packs first start, distance to the gram and number of further starts.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for doc, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                for gram, first, last, at in stretches(raw, least):
                    content = [
                        xxhash.xxh3_64_intdigest(raw[f : e + least])
                        for f, e in zip(first.tolist(), last.tolist(), strict=True)
                    ]
                    columns[0].append(gram.view(np.int64))
                    columns[1].append(np.array(content, np.uint64).view(np.int64))
                    columns[2].append(np.full(len(gram), doc, np.int64))
                    columns[3].append(np.full(len(gram), mark, np.int64))
                    columns[4].append(first << 14 | (at - first) << 7 | (last - first))
            if not columns[0]:
                continue
            gram, content, doc, mark, place = (np.concatenate(c) for c in columns)
            order, leads = _first_of_runs(gram, content, doc, mark, place)
            kept, gone = order[leads], order[~leads]
            first = place[gone] >> 14
            spans = _spans_of(
                doc[gone], mark[gone], first, first + (place[gone] & 127) + least
            )
            yield _rows(gram[kept], content[kept], doc[kept], mark[kept], place[kept], spans)

    return rows.mapInArrow(found, _STRETCH)


def _rows(gram, content, doc, mark, place, spans: pa.RecordBatch) -> pa.RecordBatch:
    """Stretches and spans in one batch of ``_STRETCH`` rows."""
    n, m = len(gram), spans.num_rows
    some = [pa.array(x, pa.int64()) for x in (gram, content, doc, mark, place)]
    none, blank = pa.nulls(m, pa.int64()), pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([some[0], none]),
            pa.concat_arrays([some[1], none]),
            pa.concat_arrays([some[2], spans.column(0)]),
            pa.concat_arrays([some[3], spans.column(1)]),
            pa.concat_arrays([some[4], none]),
            pa.concat_arrays([blank, spans.column(2)]),
            pa.concat_arrays([blank, spans.column(3)]),
        ],
        names=[f.split()[0] for f in _STRETCH.split(", ")],
    )


def _crowded(stretch_rows: DataFrame) -> Column:
    """Whether a row's gram falls into a bucket with far more rows than others."""
    bucket = F.pmod("gram", F.lit(BUCKETS))
    counts = stored(stretch_rows.groupBy(bucket.alias("bucket")).count(), "gram-buckets")
    total = counts.agg(F.sum("count")).first()[0] or 0
    limit = max(CROWD_ROWS, CROWD * total / BUCKETS)
    full = [r.bucket for r in counts.where(F.col("count") > limit).select("bucket").collect()]
    return bucket.isin(full) if full else F.lit(False)


def _compared(stretch_rows: DataFrame, least: int, crowded: Column) -> DataFrame:
    """First stretches of grams with several contents, and spans of the later equal ones.

    Rows come sorted by gram and content. Of a gram that goes on in the next batch only
    its first stretch is held, until a second content shows that it is wanted. Contents of
    crowded grams are spread over tasks, so the first stretch of each of them is kept.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the gram that goes on, its last content, and how many contents it has so far
        last_gram = last_content = None
        seen, held = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(5)]
            spread = batch.column(5).to_numpy(zero_copy_only=False)
            gram, content, doc, mark, place = columns
            goes_on = last_gram is not None and gram[0] == last_gram
            new_gram = np.append(not goes_on, gram[1:] != gram[:-1])
            leads = new_gram | np.append(
                not goes_on or content[0] != last_content, content[1:] != content[:-1]
            )
            gone = ~leads
            first = place[gone] >> 14
            spans = _spans_of(doc[gone], mark[gone], first, first + (place[gone] & 127) + least)
            group = np.cumsum(new_gram) - int(new_gram[0])
            contents = np.bincount(group[leads], minlength=int(group[-1]) + 1)
            if goes_on:
                contents[0] += seen
            kept = leads & (spread | (contents[group] > 1))
            rows = [c[kept] for c in columns]
            if goes_on and held is not None and contents[0] > 1:
                rows = [np.append(h, r) for h, r in zip(held, rows, strict=True)]
            yield _rows(*rows, spans)
            seen = int(contents[-1])
            if seen > 1 or spread[-1]:
                held = None
            elif not goes_on or group[-1] > 0:
                at = np.flatnonzero(leads)[-1]
                held = [c[at : at + 1] for c in columns]
            last_gram, last_content = gram[-1], content[-1]

    part = F.when(F.col("crowded"), F.col("content")).otherwise(F.lit(0))
    return (
        stretch_rows.withColumn("crowded", crowded)
        .repartition("gram", part)
        .sortWithinPartitions("gram", "content", "doc", "mark", "place")
        .mapInArrow(found, _STRETCH)
    )


def _wanted(leads: DataFrame, least: int, crowded: Column) -> tuple[DataFrame, DataFrame]:
    """Stretches of grams with several contents: those that meet, and those of hot grams.

    ``leads`` holds one row for each gram and content, and crowded grams with one content too.
    """
    columns = ["gram", "doc", "mark", "place"]
    counts = leads.where(crowded).groupBy("gram").count().where("count > 1")
    counts = stored(counts.withColumnRenamed("count", "n"), "crowded-grams")
    several = leads.where(crowded).join(counts, "gram").select(*columns, "n")
    is_hot = F.col("n") * least > HOT
    meeting = leads.where(~crowded).select(columns).union(several.where(~is_hot).select(columns))
    return meeting, several.where(is_hot).select(columns)


def _with_bytes(rows: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The bytes of the wanted stretches."""
    per_row = wanted.groupBy("doc", "mark").agg(
        F.collect_list("gram").alias("grams"), F.collect_list("place").alias("places")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, mark, text, grams, places in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                raw = text.encode()
                for gram, place in zip(grams, places, strict=True):
                    first = place >> 14
                    out.append(
                        (gram, doc, mark, place, raw[first : first + (place & 127) + least])
                    )
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array([o[i] for o in out], pa.int64()) for i in range(4)],
                        pa.array([o[4] for o in out], pa.binary()),
                    ],
                    names=["gram", "doc", "mark", "place", "bytes"],
                )

    return (
        rows.join(per_row, ["doc", "mark"])
        .select("doc", "mark", "text", "grams", "places")
        .mapInArrow(cut, "gram long, doc long, mark long, place long, bytes binary")
    )


_FOUND = "doc long, mark long, start long, end long, string binary"


def _dealt(held: list[tuple], least: int) -> pa.RecordBatch:
    """All strings of the stretches, by their hashes."""
    rows = []
    for _, doc, mark, place, raw in held:
        first = place >> 14
        for j in range(len(raw) - least + 1):
            digest = xxhash.xxh3_128_digest(raw[j : j + least])
            rows.append((doc, mark, first + j, first + j + least, digest))
    columns = zip(*rows, strict=True)
    types = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=[f.split()[0] for f in _FOUND.split(", ")],
    )


def _strings(parts: DataFrame, least: int) -> DataFrame:
    """The single strings of stretches, without a shuffle."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _DEALT):
                some = batch.slice(at, _DEALT)
                yield _dealt(list(zip(*(c.to_pylist() for c in some.columns), strict=True)), least)

    return parts.mapInArrow(found, _FOUND)


def _expanded(parts: DataFrame, least: int) -> DataFrame:
    """Spans by interval expansion; of hot grams the single strings (``string`` set)."""

    def spans(held: list[tuple]) -> pa.RecordBatch:
        repeats = repeated_starts([h[4] for h in held], least)
        rows = [(h, r) for h, r in zip(held, repeats, strict=True) if len(r)]
        doc = np.concatenate([np.full(len(r), h[1], np.int64) for h, r in rows] or [[]])
        mark = np.concatenate([np.full(len(r), h[2], np.int64) for h, r in rows] or [[]])
        start = np.concatenate([(h[3] >> 14) + r for h, r in rows] or [[]]).astype(np.int64)
        merged = _spans_of(doc.astype(np.int64), mark.astype(np.int64), start, start + least)
        return pa.RecordBatch.from_arrays(
            [*merged.columns, pa.nulls(merged.num_rows, pa.binary())],
            names=[f.split()[0] for f in _FOUND.split(", ")],
        )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, done_size = [], 0  # whole grams that wait for a full chunk
        group, group_size, hot = [], 0, False
        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last:
                    if hot:
                        if group:
                            yield _dealt(group, least)
                    else:
                        done += group
                        done_size += group_size
                        if done_size > CHUNK:
                            yield spans(done)
                            done, done_size = [], 0
                    group, group_size, hot, last = [], 0, False, row[0]
                group.append(row)
                group_size += len(row[4])
                if group_size > HOT:
                    hot = True
                    yield _dealt(group, least)
                    group, group_size = [], 0
        if hot:
            if group:
                yield _dealt(group, least)
        else:
            done += group
        if done:
            yield spans(done)

    return (
        parts.repartition("gram")
        .sortWithinPartitions("gram", "doc", "mark", "place")
        .mapInArrow(found, _FOUND)
    )


def _of_strings(strings: DataFrame) -> DataFrame:
    """Spans of single strings that are not the first of their kind."""
    firsts = stored(
        strings.groupBy("string").agg(F.min(F.struct("doc", "mark", "start")).alias("first")),
        "first-strings",
    )
    return (
        strings.join(firsts, "string")
        .where(F.struct("doc", "mark", "start") > F.col("first"))
        .select("doc", "mark", "start", "end")
    )


def repeat_spans(
    docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of text with the byte spans that repeat: id, text, spans (null if none).

    Order is by id (integer), a null id first, then by start. Rows that share an id count as
    texts of one document, ordered by a hash of their text; equal rows are one text: they
    repeat what comes before it, not each other. Null texts are empty; texts shorter than
    ``least`` bytes have no repeats. Spans may touch or overlap. Columns other than id
    and text are left out.
    """
    if least < GRAM or least - GRAM > 127:
        raise ValueError(f"least must lie between {GRAM} and {GRAM + 127}")
    plain = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("doc"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    again = plain.groupBy("doc").count().where("count > 1").limit(1).count()
    mark = F.xxhash64("text") if again else F.lit(0).cast("long")
    rows = plain.select("id", "doc", mark.alias("mark"), "text")
    long_rows = rows.where(F.octet_length("text") >= least).select("doc", "mark", "text")
    if again:  # equal rows are one text, found once
        long_rows = long_rows.dropDuplicates(["doc", "mark"])
    anchored = stored(_anchored(long_rows, least), "stretches")
    stretch_rows = anchored.where("gram is not null").drop("start", "end")
    crowded = _crowded(stretch_rows)
    compared = stored(_compared(stretch_rows, least, crowded), "compared")
    leads = compared.where("gram is not null").select("gram", "doc", "mark", "place")
    meeting, hot = _wanted(leads, least, crowded)
    found = stored(_expanded(_with_bytes(long_rows, meeting, least), least), "expanded")
    strings = found.where("string is not null")
    if not hot.isEmpty():
        strings = strings.union(
            stored(_strings(_with_bytes(long_rows, hot, least), least), "hot-strings")
        )
    span = ["doc", "mark", "start", "end"]
    spans = anchored.where("gram is null").select(*span)
    spans = spans.union(compared.where("gram is null").select(*span))
    spans = spans.union(found.where("string is null").select(*span))
    spans = spans.union(_of_strings(strings))
    gathered = spans.groupBy("doc", "mark").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    return rows.join(gathered, ["doc", "mark"], "left").select("id", "text", "starts", "ends")


def without_repeats(
    docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``spans`` (maximal removed runs), ``kept`` (bytes left).

    Repeats are judged on the whole input, not on what is left of it; see ``repeat_spans``
    for order, nulls and repeated rows. What is left need not be valid UTF-8.
    """
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, starts, ends in zip(
                *(c.to_pylist() for c in batch.columns[1:]), strict=True
            ):
                raw = text.encode()
                runs = merged(starts or [], ends or [])
                left, at = [], 0
                for start, end in runs:
                    left.append(raw[at:start])
                    at = end
                left.append(raw[at:])
                sizes.append(len(raw))
                spans.append([{"start": s, "end": e} for s, e in runs])
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, spans_type),
                    pa.array(kept, pa.binary()),
                ],
                names=["id", "n_bytes", "spans", "kept"],
            )

    return (
        repeat_spans(docs, least, id_col, text_col)
        .mapInArrow(
            cut,
            f"id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary",
        )
        .withColumnRenamed("id", id_col)
    )


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    runs: list[list[int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(s, e) for s, e in runs]
