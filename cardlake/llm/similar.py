"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

1. Every text becomes the sorted array of its shingles' 64-bit hashes; equal sets are one
   node. Hash buckets count how often shingles occur over all texts.
2. In order of rising bucket count, two sets that are similar enough share one of their
   first few shingles (prefix filter). Sets that share one meet in a tile of that shingle
   and of sizes that fit each other.
3. In a tile, signatures of 512 bits bound the overlap of a pair from above. Pairs that
   pass are bounded again by signatures of twice as many bits as shingles.
4. Pairs that both bounds let pass are intersected exactly.

Tiles are gone through twice: first each set is compared with the one before it that looks
most alike, which joins large groups of near copies by few comparisons; then all pairs that
are still in different components are bounded and intersected. So no link between
components is missed, and no group is expanded into all its pairs. ``links_of_sets``
compares all pairs of all tiles instead and returns every link.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.components import components
from cardlake.llm.shared import stored

SHINGLE = 4
PERCENT = 85
#: Hash buckets of the shingle counts; broadcast as one byte each.
BUCKETS = 1 << 22
#: Sets of a tile beyond which a shingle's sets are dealt over several tiles.
TILE = 8192
#: Pairs that a task remembers, so as not to give them again from another tile.
REMEMBERED = 300_000
#: Sets up to this number are broadcast to fetch their texts; beyond, it is a shuffle.
BROADCAST_SETS = 2_000_000
#: Texts of one step within a task.
STEP = 1024
#: Buckets' counts are added in so many tasks before the driver adds the rest.
ADDERS = 4

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_EMPTY = np.zeros(0, np.uint64)


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if len(words) < width:
        if not words:
            return _EMPTY
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(ids) - width + 1
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out ^= ids[j : j + n]
        out *= _FACTORS[j % 4]
        out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return np.unique(out)


def set_name(hashes: np.ndarray) -> int:
    """64-bit name of a set as a signed number; its size is part of what is hashed."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), len(hashes))).astype(np.int64))


def signature(hashes: np.ndarray) -> bytes:
    """512 bits, each the parity of the shingles that hash to it."""
    counts = np.bincount((hashes >> np.uint64(55)).astype(np.int64), minlength=512)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def wide_signature(hashes: np.ndarray) -> bytes:
    """The same with at least twice as many bits as shingles, a power of two."""
    power = max(9, (2 * len(hashes) - 1).bit_length())
    counts = np.bincount((hashes >> np.uint64(64 - power)).astype(np.int64), minlength=1 << power)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def signatures_apart(one: bytes, two: bytes) -> int:
    """Differing bits, after folding the longer signature to the length of the other."""
    small, large = sorted((np.frombuffer(x, np.uint8) for x in (one, two)), key=len)
    while len(large) > len(small):
        large = np.packbits(np.bitwise_xor.reduce(np.unpackbits(large).reshape(-1, 2), axis=1))
    return int(np.bitwise_count(small ^ large).sum(dtype=np.int64))


def prefix_length(size: int, percent: int) -> int:
    """Of so many first shingles a similar set has at least one."""
    return size - -(-percent * size // 100) + 1


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact intersection of two sorted arrays against the threshold."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    place = np.searchsorted(large, small)
    place[place == len(large)] = 0
    both = int((large[place] == small).sum())
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def may_link(na, nb, apart, percent: int):
    """The overlap is at most (na + nb - apart) / 2: can that be enough?"""
    return (100 + percent) * (na + nb - apart) >= 2 * percent * (na + nb)


def _band(size, percent: int):
    """Sizes that fit each other lie in the same or in neighbouring bands."""
    return F.floor(F.log(size.cast("double")) / math.log(100 / percent) + 1e-9).cast("int")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that little is unpacked at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, STEP):
            yield batch.slice(first, STEP)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Per row: id, n, name, signature; and per task a row with its bucket counts."""
    id_type = docs.schema["id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int32)
        kind = None
        for batch in _steps(batches):
            kind = batch.schema.field(0).type
            sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            if sets:
                low = np.concatenate(sets) & np.uint64(BUCKETS - 1)
                bucket, n = np.unique(low.astype(np.int64), return_counts=True)
                counts[bucket] += n.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_name(s) for s in sets], pa.int64()),
                    pa.array([signature(s) for s in sets], pa.binary()),
                    pa.array([wide_signature(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                names=["id", "n", "name", "bits", "wide", "counts"],
            )
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(1, kind),
                    pa.array([0], pa.int64()),
                    pa.array([0], pa.int64()),
                    pa.nulls(1, pa.binary()),
                    pa.nulls(1, pa.binary()),
                    pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary()),
                ],
                names=["id", "n", "name", "bits", "wide", "counts"],
            )

    return docs.mapInArrow(
        hashed, f"id {id_type}, n long, name long, bits binary, wide binary, counts binary"
    )


def _bucket_counts(sets: DataFrame) -> np.ndarray:
    """Sum of the tasks' counts; the driver adds ``ADDERS`` arrays at most."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(zlib.decompress(blob), np.int32)
        yield pa.RecordBatch.from_pydict({"counts": [zlib.compress(total.tobytes(), 1)]})

    blobs = sets.where("counts is not null").select("counts").repartition(ADDERS)
    total = np.zeros(BUCKETS, np.int64)
    for (blob,) in blobs.mapInArrow(added, "counts binary").collect():
        total += np.frombuffer(zlib.decompress(blob), np.int64)
    return total


def _prefixes(docs: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """Rows (shingle, deal, deals, name, n) of each set's rarest shingles.

    Shingles of much fuller buckets than usual are dealt over several tiles by set. Equal
    sets of a task give their rows once.
    """
    steps = np.minimum(255, np.floor(4 * np.log2(1 + counts))).astype(np.uint8)
    usual = float(counts.mean()) if len(counts) else 0.0
    sparing = docs.sparkSession.sparkContext.broadcast(steps)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_of, seen = sparing.value, set()
        expected = np.maximum(0.0, 2.0 ** (np.arange(256) / 4) - 8 * usual)
        deals_of = np.maximum(1, np.ceil(expected / TILE)).astype(np.int64)
        for batch in _steps(batches):
            shingles, names, sizes, steps_found = [], [], [], []
            for text in batch.column(0).to_pylist():
                hashes = shingle_set(text, width)
                name = set_name(hashes) if len(hashes) else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                step = order_of[hashes & np.uint64(BUCKETS - 1)]
                first = np.argsort(step, kind="stable")[: prefix_length(len(hashes), percent)]
                shingles.append(hashes[first])
                steps_found.append(step[first])
                names.append(np.full(len(first), name, np.int64))
                sizes.append(np.full(len(first), len(hashes), np.int64))
            if not names:
                continue
            name = np.concatenate(names)
            deals = deals_of[np.concatenate(steps_found)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(shingles).view(np.int64)),
                    pa.array((name % deals).astype(np.int32)),
                    pa.array(deals.astype(np.int32)),
                    pa.array(name),
                    pa.array(np.concatenate(sizes)),
                ],
                names=["shingle", "deal", "deals", "name", "n"],
            )

    return docs.select("text").mapInArrow(
        cut, "shingle long, deal int, deals int, name long, n long"
    )


def _tile_rows(shared: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """Each row in the tiles it belongs to: (shingle, low, high, band), side, guest.

    A set stands in the tile of its band, and as a guest in that of the next, where it
    meets larger ones if there are any. A dealt shingle has a tile for each pair of deals if all pairs are to
    meet, otherwise one for each deal and one with the first.
    """
    other = F.sequence(F.lit(0), F.col("deals") - 1) if all_pairs else F.array_distinct(
        F.array(F.col("deal"), F.lit(0))
    )
    band = _band(F.col("n"), percent)
    home = F.struct(band.alias("band"), F.lit(0).alias("guest"))
    away = F.struct((band + 1).alias("band"), F.lit(1).alias("guest"))
    return (
        shared.withColumn("other", F.explode(other))
        .withColumn(
            "at",
            F.explode(F.when(F.col("larger"), F.array(home, away)).otherwise(F.array(home))),
        )
        .select(
            "shingle",
            F.least("deal", "other").alias("low"),
            F.greatest("deal", "other").alias("high"),
            "at.band",
            "at.guest",
            (F.col("deal") > F.col("other")).cast("int").alias("side"),
            "n",
            "name",
            "root",
            "bits",
        )
    )


_KEYS = ["shingle", "low", "high", "band"]


def _tile_pairs(rows: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """Pairs (a, b) that the bound lets pass: all of them, or the best for each set."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        told: set[tuple[int, int]] = set()

        def fresh(pairs: np.ndarray) -> pa.RecordBatch:
            """Pairs that this task has not told yet; it forgets them all from time to time."""
            if len(told) > REMEMBERED:
                told.clear()
            new = [p for p in map(tuple, pairs.tolist()) if p not in told]
            told.update(new)
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in new], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 50_000:
                continue
            columns, starts = _groups(held)
            if len(starts) > 1:
                yield fresh(_checked(columns, starts[:-1], starts[1:], percent, all_pairs))
                held = held.slice(int(starts[-1])).combine_chunks()
        if held is not None and held.num_rows:
            columns, starts = _groups(held)
            ends = np.append(starts[1:], held.num_rows)
            yield fresh(_checked(columns, starts, ends, percent, all_pairs))

    return (
        rows.repartition(*_KEYS)
        .sortWithinPartitions(*_KEYS, "n", "name")
        .mapInArrow(paired, "a long, b long")
        .distinct()
    )


def _groups(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    columns = {
        c: table.column(c).to_numpy()
        for c in [*_KEYS, "guest", "side", "n", "name", "root"]
    }
    columns["bits"] = np.frombuffer(
        b"".join(table.column("bits").to_pylist()), np.uint64
    ).reshape(-1, 8)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in _KEYS:
        new[1:] |= columns[key][1:] != columns[key][:-1]
    return columns, np.flatnonzero(new)


def _checked(columns, starts, ends, percent: int, all_pairs: bool) -> np.ndarray:
    """Pairs of the groups; groups of equal size are compared together."""
    sizes = ends - starts
    found_a, found_b = [], []
    for size in np.unique(sizes[sizes > 1]):
        group_starts = starts[sizes == size]
        for first in range(0, int(size), 256):
            later = np.arange(first, min(first + 256, size))
            # rows are sorted by size and name: a pair is looked at from its larger set
            earlier = np.arange(0, later[-1] + 1)
            step = max(1, 400_000 // (len(later) * len(earlier)))
            for some in range(0, len(group_starts), step):
                base = group_starts[some : some + step, None]
                a, b = _block(
                    columns, base + later[None], base + earlier[None], percent, all_pairs
                )
                found_a.append(a)
                found_b.append(b)
    a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
    b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)


def _block(columns, later, earlier, percent: int, all_pairs: bool):
    """Pairs of rows ``later`` (groups x i) and ``earlier`` (groups x j), j before i."""
    x, y = later[:, :, None], earlier[:, None, :]
    n, name, root = columns["n"], columns["name"], columns["root"]
    fits = (y < x) & (100 * n[y] >= percent * n[x]) & (root[x] != root[y]) & (name[x] != name[y])
    fits &= (columns["guest"][x] & columns["guest"][y]) == 0
    split = columns["low"][x] != columns["high"][x]
    fits &= ~split | (columns["side"][x] != columns["side"][y])
    g, i, j = np.nonzero(fits)
    p, q = later[g, i], earlier[g, j]
    apart = np.bitwise_count(columns["bits"][p] ^ columns["bits"][q]).sum(1, dtype=np.int64)
    passed = may_link(n[p], n[q], apart, percent)
    p, q, apart = p[passed], q[passed], apart[passed]
    if not all_pairs and len(p):
        order = np.lexsort([apart, p])
        p, q = p[order], q[order]
        best = np.append(True, p[1:] != p[:-1])
        p, q = p[best], q[best]
    return name[p], name[q]


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the wide signatures let pass."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                may_link(na, nb, signatures_apart(one, two), percent)
                for _, _, na, nb, one, two in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True
                )
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = nodes.select(
        F.col("name").alias("a"), F.col("n").alias("na"), F.col("wide").alias("one")
    )
    right = nodes.select(
        F.col("name").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("two")
    )
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "na", "nb", "one", "two")
        .mapInArrow(checked, "a long, b long")
    )


def _linked(
    pairs: DataFrame, docs: DataFrame, nodes: DataFrame, unique: bool, width: int, percent: int
) -> DataFrame:
    """The pairs whose sets are alike: bounded by wide signatures, then intersected."""
    pairs = stored(_bounded(pairs, nodes, percent), "pairs")
    meeting = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    meeting = stored(nodes.join(meeting, "name").select("name", "id"), "meeting")
    texts = stored(_texts(docs, meeting, unique, width), "texts")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, _EMPTY
        for batch in batches:
            keep = []
            for a, b, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != last:
                    last, last_set = b, shingle_set(two, width)
                keep.append(alike(shingle_set(one, width), last_set, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("name").alias("a"), F.col("text").alias("one"))
    right = texts.select(F.col("name").alias("b"), F.col("text").alias("two"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "one", "two")
        .mapInArrow(checked, "a long, b long")
    )


def _texts(docs: DataFrame, nodes: DataFrame, unique: bool, width: int) -> DataFrame:
    """One text of every set in ``nodes`` (name, id). ``unique``: no id occurs twice."""
    wanted = nodes.select(F.col("id").alias("__id"), F.col("name").alias("__name"))
    if nodes.count() <= BROADCAST_SETS:
        wanted = F.broadcast(wanted)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [set_name(shingle_set(t, width)) for t in batch.column(1).to_pylist()]
            same = pa.array(np.array(names, np.int64) == batch.column(0).to_numpy())
            yield batch.filter(same)

    found = docs.join(wanted, F.col("id").eqNullSafe(F.col("__id"))).select(
        F.col("__name").alias("name"), "text"
    )
    if unique:
        return found
    # of rows that repeat an id only those with the wanted set pass, and equal ones once
    return found.mapInArrow(named, "name long, text string").dropDuplicates(["name"])


def _prepared(
    docs: DataFrame, width: int, percent: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame, bool, DataFrame]:
    """Rows (id, text), their sets, the distinct sets, whether ids are unique, rare shingles."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = stored(_sets(rows, width), "sets")
    counts = _bucket_counts(sets)
    named = sets.where("n > 0")
    nodes = stored(
        named.groupBy("name").agg(
            F.min("id").alias("id"),
            F.first("n").alias("n"),
            F.first("bits").alias("bits"),
            F.first("wide").alias("wide"),
        ),
        "nodes",
    )
    repeated = sets.where("counts is null").groupBy("id").count().where("count > 1")
    unique = not repeated.limit(1).count()
    group = Window.partitionBy("shingle", "deal")
    prefixes = (
        _prefixes(rows, counts, width, percent)
        .withColumn("least", F.min("name").over(group))
        .withColumn("most", F.max("name").over(group))
        .withColumn("largest", F.max("n").over(group))
        .withColumn("before", F.lag("n").over(group.orderBy("n")))
        .withColumn("after", F.lead("n").over(group.orderBy("n")))
        # some other set of the shingle has a size that fits
        .where(
            (F.col("deals") > 1)
            | (F.col("least") < F.col("most"))
            & ((100 * F.col("before") >= percent * F.col("n"))
               | (100 * F.col("n") >= percent * F.col("after")))
        )
        .withColumn(
            "larger",
            (F.col("deals") > 1) | (_band(F.col("largest"), percent) > _band(F.col("n"), percent)),
        )
        .select("shingle", "deal", "deals", "name", "n", "larger")
    )
    shared = stored(prefixes, "prefixes")
    return rows, sets, nodes, unique, shared


def linked_documents(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id``.

    Two rows link when 100 * intersection >= ``percent`` * union of their shingle sets; the
    component is the smallest id reachable by links, the row's own included. Words are
    runs without ASCII white space, A-Z in lower case. Null, empty and blank texts have an
    empty set and link with nothing. Rows with equal sets link, rows that repeat an id too
    if their texts do; a null id is passed over in the smallest id. Columns other than id
    and text are left out. Sets are known by 64-bit hashes, of shingles and of whole sets.
    """
    rows, sets, nodes, unique, shared = _prepared(docs, width, percent, id_col, text_col)
    about = nodes.select("name", "bits")
    first = shared.join(about, "name").withColumn("root", F.col("name"))
    pairs = _tile_pairs(_tile_rows(first, percent, False), percent, False)
    links = stored(_linked(pairs, rows, nodes, unique, width, percent), "links")
    roots = components(links)
    # what is left: groups that still hold several components
    about = stored(
        about.join(roots, F.col("name") == F.col("node"), "left").select(
            "name", "bits", F.coalesce("root", "name").alias("root")
        ),
        "roots-of-sets",
    )
    rest = shared.join(about, "name")
    several = (
        rest.groupBy("shingle")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"))
        .where("least < most")
        .select("shingle")
    )
    rest = rest.join(stored(several, "several"), "shingle", "left_semi")
    pairs = _tile_pairs(_tile_rows(rest, percent, True), percent, True)
    more = stored(_linked(pairs, rows, nodes, unique, width, percent), "more-links")
    roots = components(links.union(more))
    # ids by component, then back to every row
    placed = nodes.select("name", "id").join(roots, F.col("name") == F.col("node"), "left")
    placed = placed.select("name", "id", F.coalesce("root", "name").alias("root"))
    lowest = placed.groupBy(F.col("root").alias("top")).agg(F.min("id").alias("component_id"))
    found = placed.join(lowest, F.col("root") == F.col("top")).select(
        F.col("name").alias("__name"), "component_id"
    )
    result = sets.where("counts is null").join(
        stored(found, "components"), (F.col("name") == F.col("__name")) & (F.col("n") > 0), "left"
    )
    return result.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def links_of_sets(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """All links (a, b) between different sets, and the rows (id, ``set``, ``n_shingles``) with them.

    ``a`` < ``b`` are sets as ``set`` names them, each link once; rows of one set link too and
    are not listed as pairs. ``set`` is null for a row without words, which links with nothing.
    Unlike ``linked_documents`` every pair that meets in a tile is compared, those of one
    component too, so a large group of different near copies costs as much as it has links.
    """
    rows, sets, nodes, unique, shared = _prepared(docs, width, percent, id_col, text_col)
    apart = shared.join(nodes.select("name", "bits"), "name").withColumn("root", F.col("name"))
    pairs = _tile_pairs(_tile_rows(apart, percent, True), percent, True)
    links = stored(_linked(pairs, rows, nodes, unique, width, percent), "all-links")
    members = sets.where("counts is null").select(
        F.col("id").alias(id_col),
        F.when(F.col("n") > 0, F.col("name")).alias("set"),
        F.col("n").alias("n_shingles"),
    )
    return links, members


def link_counts(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``n_links``: the other rows it links with.

    Rows with equal sets link with each other, copies counted one by one. Sets are
    counted first, so copies are never made into pairs.
    """
    links, members = links_of_sets(docs, width, percent, id_col, text_col)
    copies = members.where("set is not null").groupBy("set").agg(F.count("*").alias("copies"))
    copies = stored(copies, "copies")
    both = links.select("a", "b").union(links.select("b", "a"))
    others = (
        both.join(copies.toDF("b", "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    )
    found = copies.join(others, F.col("set") == F.col("a"), "left").select(
        F.col("set").alias("__set"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    return members.join(stored(found, "link-counts"), F.col("set") == F.col("__set"), "left").select(
        id_col, "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def one_of_each(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all columns kept.

    Rows that share an id stay or go together; rows with an empty set all stay, as do rows
    with a null id whose component has no other id.
    """
    found = linked_documents(docs, width, percent, id_col, text_col)
    kept = stored(
        found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
        .select(F.col(id_col).alias("__kept"))
        .distinct(),
        "kept",
    )
    # by shuffle at every size: the kept ids grow with the corpus
    return docs.join(kept.hint("merge"), F.col(id_col).eqNullSafe(F.col("__kept")), "left_semi")
