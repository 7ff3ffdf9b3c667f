"""SimHash fingerprints of 128 bits, all fingerprints within a Hamming radius, and near copies.

Terms are runs of five words (a shorter text is one term). A term's hash votes on
every bit as often as the term occurs; a bit is set if more than half of the votes
are for it. A Jaccard likeness of 0.8 is about 19 differing bits; the radius of 23 holds
most pairs as alike as that, and the exact likeness of term sets counts the others too.
DataFrame functions only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.shared import stored

SHINGLE = 5
BITS = 128
RADIUS = 23
#: Bits by which a block of a block table may differ, and the fewest blocks there are.
FLIPS, BLOCKS = 2, 4
#: Percent of Jaccard likeness of near copies.
PERCENT = 80
#: Terms that so many asked texts hold are hot, at most so many of them.
HOT_TEXTS, HOT_TERMS = 16, 4096
#: Votes are first added eight to a signed long, so at most 127 of them.
CHUNK = 127
_LANES = 0x0101010101010101
#: Term hashes of a set have 62 bits; the next one puts hot terms last.
_RANKED, _LAST = 2**62 - 1, 2**62
_WHITE = " \t\n\x0b\f\r"
_LOWEST = -(2**63)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; a blank text has one empty word."""
    return F.split(F.btrim(text, F.lit(_WHITE)), r"[\x20\x09-\x0D]+")


def fingerprinted(rows: DataFrame, text_col: str, keys: list[str], carried: list[str]) -> DataFrame:
    """``keys``, ``carried`` and ``fingerprint`` (32 hexadecimal digits) of every row.

    ``keys`` must tell the rows apart. If ``rows`` is already partitioned by some of
    them, nothing is shuffled. ``carried`` columns must be the same for a key. Null
    and blank texts share the fingerprint of the empty word.
    """
    words = rows.select(
        *keys, *carried, words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("__words")
    )
    terms = words.select(
        *keys,
        *carried,
        "__words",
        F.explode(
            F.sequence(F.lit(0), F.greatest(F.size("__words") - SHINGLE, F.lit(0)))
        ).alias("__i"),
    ).select(
        *keys,
        *carried,
        (F.col("__i") / CHUNK).cast("int").alias("__chunk"),
        F.xxhash64(*[F.get("__words", F.col("__i") + j) for j in range(SHINGLE)]).alias("__h0"),
    )
    terms = terms.withColumn("__h1", F.xxhash64("__h0", F.lit(1)))
    lanes = [
        F.sum(F.shiftright(f"__h{h}", b).bitwiseAND(F.lit(_LANES))).alias(f"__s{h}_{b}")
        for h in (0, 1)
        for b in range(8)
    ]
    chunks = terms.groupBy(*keys, *carried, "__chunk").agg(F.count("*").alias("__n"), *lanes)
    votes = chunks.groupBy(*keys, *carried).agg(
        F.sum("__n").alias("__n"),
        *[
            F.sum(F.shiftright(f"__s{h}_{b}", 8 * lane).bitwiseAND(F.lit(255))).alias(
                f"__v{h}_{8 * lane + b}"
            )
            for h in (0, 1)
            for b in range(8)
            for lane in range(8)
        ],
    )

    def nibble(h: int, high: int) -> Column:
        value = sum(
            (F.col(f"__v{h}_{high - j}") * 2 > F.col("__n")).cast("int") * (8 >> j)
            for j in range(4)
        )
        return F.substring(F.lit("0123456789abcdef"), value + 1, F.lit(1))

    digits = [nibble(h, high) for h in (0, 1) for high in range(63, -1, -4)]
    return votes.select(*keys, *carried, F.concat(*digits).alias("fingerprint"))


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two fingerprints."""
    parts = [
        F.bit_count(
            F.conv(F.substring(a, s, 8), 16, 10)
            .cast("long")
            .bitwiseXOR(F.conv(F.substring(b, s, 8), 16, 10).cast("long"))
        )
        for s in (1, 9, 17, 25)
    ]
    return parts[0] + parts[1] + parts[2] + parts[3]


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - distance(a, b).cast("double") / BITS


def _blocks(radius: int, flips: int) -> list[tuple[int, int]]:
    """Hexadecimal digits (from, to) of the blocks: one of them has ``flips`` differences at most."""
    digits, number = BITS // 4, max(BLOCKS, radius // (flips + 1) + 1)
    edges = [digits * j // number for j in range(number + 1)]
    return list(zip(edges, edges[1:], strict=False))


def _words_of_bits(fingerprint: Column) -> list[Column]:
    """The fingerprint as two longs of 64 bits."""
    quarters = [F.conv(F.substring(fingerprint, d + 1, 8), 16, 10).cast("long") for d in (0, 8, 16, 24)]
    return [F.shiftleft(quarters[i], 32).bitwiseOR(quarters[i + 1]) for i in (0, 2)]


def _digits_of(high: Column, low: Column) -> Column:
    """The 32 hexadecimal digits of two longs."""
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def _block(high: Column, low: Column, cut: tuple[int, int]) -> Column:
    """The digits from .. to of a fingerprint as a number; a block has 32 bits at most."""
    first, last = cut
    only = F.lit((1 << 4 * (last - first)) - 1).cast("long")
    if last <= 16:
        return F.shiftrightunsigned(high, 64 - 4 * last).bitwiseAND(only)
    rest = F.shiftrightunsigned(low, 128 - 4 * last)
    if first < 16:
        rest = rest.bitwiseOR(F.shiftleft(high, 4 * (last - 16)))
    return rest.bitwiseAND(only)


def _masks(bits: int, flips: int) -> Column:
    """All numbers of ``bits`` bits of which at most ``flips`` are set."""
    set_bits = (c for k in range(flips + 1) for c in combinations(range(bits), k))
    return F.array(*[F.lit(sum(1 << b for b in c)).cast("long") for c in set_bits])


def within_radius(
    queries: DataFrame,
    points: DataFrame,
    radius: int = RADIUS,
    column: str = "fingerprint",
    flips: int = FLIPS,
) -> DataFrame:
    """``fingerprint``, ``near``, ``distance``, ``n``: all distinct pairs in the radius.

    Both sides are brought to distinct fingerprints first; ``n`` counts the rows of
    ``points`` with the fingerprint ``near``, copies of the query included. A fingerprint
    is cut into so many blocks that in one of them a pair of the radius differs by
    ``flips`` bits at most. Each point enters one table per block, the block moved to
    the front as the key; a query looks up every key that near to its own. Pairs that meet
    are compared in full and given by the first table they meet in, so nothing is lost or
    twice. Null fingerprints find nothing.
    """
    if not 0 <= radius < BITS // 4:
        raise ValueError("the radius must be below 32")
    if not 0 <= flips <= 3:
        raise ValueError("a block may differ by 0 to 3 bits")
    cuts = _blocks(radius, flips)
    tables = [F.lit(no << 32).cast("long") for no in range(len(cuts))]

    def keys(high: str, low: str, of_block) -> Column:
        blocks = [_block(F.col(high), F.col(low), cut) for cut in cuts]
        return F.flatten(
            F.array(*[of_block(t.bitwiseOR(x), cut) for t, x, cut in zip(tables, blocks, cuts, strict=True)])
        )

    def nearby(key: Column, cut: tuple[int, int]) -> Column:
        masks = _masks(4 * (cut[1] - cut[0]), flips)
        return F.transform(masks, lambda mask: mask.bitwiseXOR(key))

    def halves(rows: DataFrame, names: list[str], *more: str) -> DataFrame:
        found = _words_of_bits(F.col(column))
        return rows.select(*[c.alias(n) for c, n in zip(found, names, strict=True)], *more)

    asked = queries.where(F.col(column).isNotNull()).select(column).distinct()
    asked = halves(asked, ["a0", "a1"])
    asked = asked.select(F.explode(keys("a0", "a1", nearby)).alias("key"), "a0", "a1")
    held = points.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    held = halves(held, ["b0", "b1"], "n")
    held = held.select(
        F.explode(keys("b0", "b1", lambda key, _: F.array(key))).alias("key"), "b0", "b1", "n"
    )
    apart = [F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")) for i in (0, 1)]
    first = F.coalesce(
        *[F.when(F.bit_count(_block(*apart, cut)) <= flips, t) for t, cut in zip(tables, cuts, strict=True)]
    )
    # by shuffle at every size: the planner does not know how many keys are looked up
    return (
        asked.join(held.hint("merge"), "key")
        .withColumn("distance", F.bit_count(apart[0]) + F.bit_count(apart[1]))
        .where(F.col("distance") <= radius)
        .where(first == F.shiftleft(F.shiftrightunsigned("key", 32), 32))
        .select(
            _digits_of(F.col("a0"), F.col("a1")).alias("fingerprint"),
            _digits_of(F.col("b0"), F.col("b1")).alias("near"),
            "distance",
            "n",
        )
    )


def _terms(words: str) -> Column:
    """Sorted distinct 62-bit hashes of the terms of a column of words."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
    terms = F.transform(
        places,
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]).bitwiseAND(
            F.lit(_RANKED)
        ),
    )
    return F.sort_array(F.array_distinct(terms))


def _words(text: str, name: str) -> Column:
    return words_of(F.coalesce(text, F.lit(""))).alias(name)


def _least(n: Column, percent: int) -> Column:
    """Smallest whole number of at least ``percent`` of ``n``."""
    return F.ceil(n * percent / 100).cast("int")


def _rarest(texts: DataFrame, hot: list[int], percent: int) -> DataFrame:
    """Rows (term, key, n) of each set's first terms, hot ones last: alike sets share one."""
    sets = texts.select("key", _words("text", "__words")).select("key", _terms("__words").alias("terms"))
    sets = sets.select("key", "terms", F.size("terms").alias("n"))
    ranked = F.col("terms")
    if hot:
        ranked = F.sort_array(
            F.transform(
                ranked, lambda h: F.when(h.isin(hot), h.bitwiseOR(F.lit(_LAST))).otherwise(h)
            )
        )
    first = F.slice(ranked, F.lit(1), F.col("n") - _least(F.col("n"), percent) + 1)
    return sets.select(F.explode(first).alias("term"), "key", "n")


def text_key(text: Column) -> Column:
    """64-bit hash by which ``alike_counts`` knows a text; null is empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def alike_counts(
    queries: DataFrame, points: DataFrame, percent: int = PERCENT, text_col: str = "text"
) -> DataFrame:
    """``key`` of each text of ``queries``, ``n_alike``: rows of ``points`` alike, copies included.

    Alike is a Jaccard likeness of the term sets of ``percent`` or more, decided exactly (up to
    collisions of 62-bit hashes) whatever the fingerprints say. Two sets so alike share one of
    their first terms in any common order (prefix filter). Terms that many asked texts hold
    come last in it, so a passage that a third of all texts hold brings few pairs
    together. A pair's overlap is at most what its first terms share and all further
    terms of one set; texts are fetched only where that can be enough.
    """
    rows = points.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    asked = queries.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    asked = stored(asked.dropDuplicates(["key"]), "asked")
    hot = [
        r[0]
        for r in asked.select(_words("text", "__words"))
        .select(F.explode(_terms("__words")).alias("term"))
        .groupBy("term")
        .count()
        .where(F.col("count") >= HOT_TEXTS)
        .orderBy(F.desc("count"), "term")
        .limit(HOT_TERMS)
        .collect()
    ]
    left = _rarest(asked, hot, percent).toDF("term", "a", "na")
    right = _rarest(rows, hot, percent).toDF("term", "b", "nb")
    further = F.greatest(_least(F.col("na"), percent), _least(F.col("nb"), percent)) - 1
    pairs = stored(
        left.join(right, "term")
        .where(F.col("a") != F.col("b"))
        .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.count_distinct("term").alias("shared"))
        .where(
            (100 + percent) * (F.col("shared") + further) >= percent * (F.col("na") + F.col("nb"))
        )
        .select("a", "b"),
        "alike-pairs",
    )
    meeting = stored(pairs.select(F.col("b").alias("key")).distinct(), "alike-meeting")
    others = rows.join(meeting, "key", "left_semi").dropDuplicates(["key"])
    # texts take less room than their terms
    both = F.size(F.array_intersect("x", "y"))
    overlaps = (
        pairs.join(asked.toDF("a", "one"), "a")
        .join(others.toDF("b", "two"), "b")
        .select("a", "b", _words("one", "__one"), _words("two", "__two"))
        .select("a", "b", _terms("__one").alias("x"), _terms("__two").alias("y"))
        .select("a", "b", (F.size("x") + F.size("y")).alias("sum"), both.alias("both"))
    )
    # stored before it is filtered: a filter pushed down would split the texts for every term
    links = (
        stored(overlaps, "alike-overlaps")
        .where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both")))
        .select("a", "b")
    )
    links = stored(links.union(asked.select("key", "key")), "alike-links")
    held = rows.groupBy(F.col("key").alias("b")).agg(F.count("*").alias("n"))
    return (
        links.join(held, "b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n_alike"))
    )


def in_order(
    docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows with their successor's text, in order of id (integer), then text.

    Columns: bucket, place, guest, id, text, next_text. The first row follows the last.
    Buckets are ranges of ids between approximate quantiles, so no task sorts more than
    its share. The first rows of each bucket also stand, as guests, at the end of
    the bucket before; drop them after use. A null id comes before all others.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    rows = docs.select(
        key.alias("key"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    shares = [j / buckets for j in range(1, buckets)]
    found = rows.agg(
        F.min("key").alias("low"),
        *([F.percentile_approx("key", shares, 20 * buckets).alias("cuts")] if shares else []),
    ).first()
    cuts = sorted({*(found["cuts"] or [] if shares else []), found["low"]} - {None}) or [0]
    # two steps of about sqrt(buckets) comparisons each instead of one per cut
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[j : j + step] for j in range(0, len(cuts), step)]
    tops = F.lit([g[0] for g in groups])
    inner = F.array(*[F.lit(g) for g in groups])
    group = F.size(F.filter(tops, lambda c: c <= F.col("key")))
    rows = rows.withColumn("__g", group).withColumn(
        "bucket",
        (F.col("__g") - 1) * step
        + F.size(F.filter(F.get(inner, F.col("__g") - 1), lambda c: c <= F.col("key")))
        - 1,
    )
    first = F.get(F.get(inner, F.col("__g") - 1), (F.col("bucket") % step)) == F.col("key")
    before = F.when(F.col("bucket") == 0, len(cuts) - 1).otherwise(F.col("bucket") - 1)
    home = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    away = F.struct(before.alias("bucket"), F.lit(True).alias("guest"))
    rows = rows.select(
        "key", "id", "text",
        F.explode(F.when(first, F.array(home, away)).otherwise(F.array(home))).alias("at"),
    ).select("at.*", "key", "id", "text")
    order = Window.partitionBy("bucket").orderBy("guest", "key", "text")
    return rows.select(
        "bucket",
        F.row_number().over(order).alias("place"),
        "guest",
        "id",
        "text",
        F.lead("text").over(order).alias("next_text"),
    )
