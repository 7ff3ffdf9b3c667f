"""Quality rules against plain forms. The whole query is compared by SQL."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cardlake.llm import rules
from cardlake.llm.rules import Limits


def plain(text, least):
    """Length of the longest string at each place that occurs elsewhere, by trying all."""
    n, best = len(text), [0] * len(text)
    for i in range(n):
        for j in range(n):
            length = 0
            while i != j and i + length < n and j + length < n and text[i + length] == text[j + length]:
                length += 1
            best[i] = max(best[i], length)
    return [b if b >= least else 0 for b in best]


@pytest.mark.parametrize("seed", range(40))
def test_repeats_by_trying_all(seed):
    draw = random.Random(seed)
    letters = "ab\U0001f600é"[: draw.choice([1, 2, 4])]
    text = "".join(draw.choice(letters) for _ in range(draw.randint(2, 60)))
    if seed % 3 == 0:
        text += text[: draw.randint(1, 30)] + text
    for least in (1, 2, 5, 9, 17):
        spans, longest = rules.repetition(text, least)
        lengths = plain(text, least) if len(text) > least else [0]
        places = {p for i, n in enumerate(lengths) for p in range(i, i + n)}
        assert {p for s, e in spans for p in range(s, e)} == places
        assert longest == max(lengths)
        assert all(e < s for (_, e), (s, _) in zip(spans, spans[1:]))


def test_repeats_over_the_packed_width():
    """Alphabets of one bit to twenty, where one to many characters fit a key."""
    for size in (1, 3, 200, 70_000):
        codes = np.random.default_rng(size).integers(1, size + 1, 500)
        codes = np.concatenate([codes, [size + 1], codes[100:180], [size + 2], codes[100:180]])
        lengths = rules.repeated_from(codes, 60)
        assert lengths[501] >= 80 and lengths[582] >= 80 and lengths[100] >= 80


def test_long_text_in_little_time():
    text = "ab" * 300_000
    spans, longest = rules.repetition(text, 40)
    assert spans.tolist() == [[0, 600_000]] and longest == 599_998


WORDS = " ".join(f"word{i}" for i in range(60))
ONCE = "one sentence of some length that is written exactly two times in a text. "
SCHEMA = "doc_id long, text string, kept string, n_words string, x int"


def test_verdicts(spark):
    texts = [
        None, "", " \n\t ", "few words", WORDS, WORDS + " " + WORDS, WORDS + "\n" + ONCE + ONCE,
        "a b c " * 100, WORDS + "\n\n\nline\nline\n line\n" + "#*$%&|<>#", WORDS.replace(" ", "\xa0"),
    ]
    rows = [(i, t, "old", None, 1) for i, t in enumerate(texts)] + [(4, WORDS, "old", None, 1)]
    found = rules.judged(spark.createDataFrame(rows, SCHEMA)).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and found[0].x == 1
    assert [r.kept for r in found] == [False] * 4 + [True, False, True, False, True, False, True]
    assert [r.base_failed for r in found[:6]] == [True] * 4 + [False, True]
    assert by_id[5].longest_repeat == len(WORDS) and by_id[5].n_repeat_words == 120
    assert by_id[6].repeats == [[len(WORDS) + 1, len(WORDS) + 1 + 2 * len(ONCE)]]
    assert (by_id[8].n_symbols, by_id[8].n_dup_lines) == (9, 1)
    assert by_id[9].n_words == 1


def test_limits(spark):
    frame = spark.createDataFrame([(1, WORDS + "\n" + ONCE + ONCE)], "doc_id long, text string")
    for limits, kept in (
        (Limits(), True), (Limits(covered_percent=20), False), (Limits(longest_repeat=72), False),
        (Limits(least_repeat=80, covered_percent=0), True), (Limits(least_words=100), False),
    ):
        assert rules.judged(frame, limits).first().kept == kept


def test_no_rows(spark):
    assert rules.judged(spark.createDataFrame([], SCHEMA)).collect() == []
