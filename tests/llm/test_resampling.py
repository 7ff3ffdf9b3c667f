"""Resampling: head and tail give the same buckets, ranks are whole, and the edges.

The query with its production parameters is compared by SQL.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pytest

from cardlake.llm import resampling
from cardlake.llm.resampling import Vocabulary


def plain_buckets(text, width, buckets):
    words = "".join(
        c.lower() if "A" <= c <= "Z" else c if c.isascii() and c.isalnum() or c >= "\x80" else " "
        for c in text or ""
    ).split(" ")
    words = [w for w in words if w]
    return [
        crc32(" ".join(words[i : i + k]).encode()) % buckets
        for k in range(1, width + 1)
        for i in range(len(words) - k + 1)
    ]


TEXTS = ["", None, "One", "The cat, the CAT", "the cat the dog\nthe cat x É é 1-2", "ÀB a\x00b"]


@pytest.mark.parametrize("width", [1, 2, 3])
def test_head_and_tail_agree(width):
    words = {b"the": crc32(b"the"), b"cat": crc32(b"cat")}
    pairs = {b"the cat": crc32(b"the cat") % 97} if width == 2 else {}
    for known in (Vocabulary({}, {}, width, 97), Vocabulary(words, pairs, width, 97)):
        for text in TEXTS:
            got = known.buckets_of(resampling.words_of(text)).tolist()
            assert got == plain_buckets(text, width, 97)
    assert len(known.states) == 2


def test_pairs_of_the_whole_table(spark, sf_dir, table):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = resampling.weighed(docs, target, width=2, buckets=500).collect()
    texts = dict(table("documents", "doc_id, text"))
    found = {i: plain_buckets(t, 2, 500) for i, t in texts.items()}
    source = np.bincount(sum(found.values(), []), minlength=500)
    wanted = sum((plain_buckets(t, 2, 500) for (t,) in table("benchmark", "text")), [])
    gain = resampling.gains(np.bincount(wanted, minlength=500), source)
    assert {r.doc_id: (r.n_features, r.weight) for r in rows} == {
        i: (len(b), sum(gain[b].tolist())) for i, b in found.items()
    }


def test_head_is_exact_and_bounded(spark):
    docs = spark.createDataFrame(
        [("b b b b a a a " + "w" * 80,), ("a c c d",), (None,), ("w" * 80,)] * 3, "text string"
    ).repartition(5)
    # b and a occur 12 times each, c 6 times, d 3 times
    for head, words in ((1, set()), (2, {b"a", b"b"}), (3, {b"a", b"b", b"c"}), (9, {b"a", b"b", b"c", b"d"})):
        assert set(resampling.vocabulary(docs, head=head).states) == words
    assert set(resampling.vocabulary(docs, width=2, head=1).pairs) == {b"b b"}


def score(doc_id, weight):
    h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def test_ranks_over_many_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    rows = [(i % 700 if i % 3 else 7, 20 + i % 2, 20, (i * i) % 900) for i in range(2100)]
    rows += [(None, 50, 50, 10**6), (5000, 19, 19, 10**7)]
    try:
        frame = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long")
        found = resampling.drawn(frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len(rows)
    assert all(r.score == score(r.doc_id, r.weight) for r in found)
    ranked = sorted((r["rank"], r) for r in found if r["rank"])
    assert [n for n, _ in ranked] == list(range(1, 2101 // 10 + 1))
    order = sorted(
        ((score(i, w), i) for i, n, _, w in rows if n >= 20),
        key=lambda x: (-x[0], math.inf if x[1] is None else x[1]),
    )
    assert [(r.score, r.doc_id) for _, r in ranked] == order[:210]


SCHEMA = "doc_id long, text string, weight string, n_words int, score int, rank int, extra int"


@pytest.mark.parametrize("rows", [True, False])
def test_edges(spark, rows):
    long = " ".join(f"w{i}" for i in range(3000))
    data = [(1, None), (2, ""), (3, long), (3, long), (None, long), (4, "too few words")] if rows else []
    docs = spark.createDataFrame([(*r, "x", 1, 1, 1, 9) for r in data], SCHEMA)
    for target in (docs.where("false"), docs):
        found = resampling.drawn(resampling.weighed(docs, target), percent=50).collect()
        assert len(found) == len(data)
        for r in found:
            assert r.extra == 9 and r.n_words == len((r.text or "").split())
            assert r.weight == 0 if not r.text else True
        assert [r["rank"] for r in found if r["rank"]] == ([1] if rows else [])
