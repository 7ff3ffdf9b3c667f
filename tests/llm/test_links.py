"""Links between sets, components and dealt tiles against all pairs by brute force."""

from __future__ import annotations

import re

import pytest

from cardlake.llm import similar


def shingles(text, width=similar.SHINGLE):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    if not lower:
        return frozenset()
    return frozenset(tuple(lower[j : j + width]) for j in range(max(1, len(lower) - width + 1)))


def brute(docs):
    """Links per row and smallest id reachable."""
    sets = [shingles(t) for _, t in docs]
    near = [
        [
            j
            for j, other in enumerate(sets)
            if i != j and mine and other and 100 * len(mine & other) >= 85 * len(mine | other)
        ]
        for i, mine in enumerate(sets)
    ]
    lowest = {}
    for i, (doc_id, _) in enumerate(docs):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [docs[j][0] for j in seen if docs[j][0] is not None]
        lowest[i] = (doc_id, len(sets[i]), min(ids) if ids else None)
    counts = sorted(((docs[i][0], len(sets[i]), len(n)) for i, n in enumerate(near)), key=str)
    return counts, sorted(lowest.values(), key=str)


def chain():
    """Near copies in a row, of which only neighbours link, copies of them, hot words, edges."""
    hot = [f"h{j}" for j in range(12)]
    words = [f"w{j}" for j in range(120)]
    docs = [(None, None), (0, ""), (1, " \n"), (2, "One"), (3, "one"), (4, "a b c"), (None, "a b c")]
    for k in range(40):
        # every step changes three words more, at the end of the text
        changed = words[: 120 - 3 * k] + [f"x{j}" for j in range(3 * k)]
        docs.append((10 + k, " ".join(hot + changed)))
    docs += [(100 + k, docs[7 + k][1].upper()) for k in range(0, 40, 5)]
    docs += [(200 + k, " ".join(hot + [f"k{k}w{j}" for j in range(50)])) for k in range(30)]
    docs += [(200, docs[-30][1]), (300, " ".join(words * 40)), (301, " ".join(words * 41))]
    return docs


@pytest.mark.parametrize("tile", [similar.TILE, 5])
def test_links_and_components(spark, monkeypatch, tile):
    """With a tile of 5 sets the shingles that many share are dealt over several tiles."""
    monkeypatch.setattr(similar, "TILE", tile)
    docs = chain()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    counts, components = brute(docs)
    rows = similar.link_counts(frame).collect()
    assert sorted((tuple(r) for r in rows), key=str) == counts
    assert max(r.n_links for r in rows) > 5
    rows = similar.linked_documents(frame).collect()
    assert sorted((tuple(r) for r in rows), key=str) == components


def test_links_are_given_once(spark):
    frame = spark.createDataFrame(chain(), "doc_id long, text string")
    links, members = similar.links_of_sets(frame)
    pairs = [tuple(r) for r in links.select("a", "b").collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    assert {x for p in pairs for x in p} <= {r["set"] for r in members.collect()}


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, n_links int")
    assert similar.link_counts(frame).collect() == []
