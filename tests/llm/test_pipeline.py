"""Each stage of the pipeline against a plain form, on what the stage before it kept."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from cardlake.llm.shared import stored
from tests.conftest import TESTDATA
from tests.llm import brute

SMALL = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage; the last input has odd rows from the start."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = docs.where("length(text) > 600").orderBy("doc_id").first().text
    odd = [(90001, None), (90002, ""), (90003, text), (90004, text + " more words here"),
           (90005, text + " password = hunter22xQ9zZ81kk " + "AKIA" + "Q7W3E9R5T1Y8U2I6")]
    rows = [(i, t, "en", "planted", len(t or "")) for i, t in odd]
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    out, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SMALL), name.replace(" ", "-"))
        out[name] = (docs, after)
        docs = after
        assert name == corpus_pipeline.STAGES[-1][0] or after.columns == columns
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_are_those_of_the_contract(stages):
    assert list(stages) == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination",
        "secret scans", "best-fit packing",
    ]


def test_quality(stages, spark):
    from cardlake.llm import quality

    before, after = stages["quality classifier"]
    voters = quality.trained(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    counts = {i: quality.counts_of(t) for i, t in texts(before).items()}
    good = {i for i, c in counts.items() if voters.scores(c[None])[0] >= quality.THRESHOLD}
    assert set(texts(after)) == good and 0 < len(good) < len(counts) + 1


def test_near_copies(stages):
    before, after = (texts(f) for f in stages["n-gram Jaccard join"])
    sets = {}
    for i, text in before.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(brute.UPPER))
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert set(after) == {i for i in sets if root(i) == i}
    assert len(after) < len(before)


def test_decontamination(stages, spark):
    before, after = (texts(f) for f in stages["benchmark decontamination"])
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = brute.contamination(before.items(), items)
    assert set(after) == {i for i in before if not found[i][4]}


def test_secrets(stages):
    from cardlake.llm import secrets

    before, after = stages["secret scans"]
    old, new = texts(before), texts(after)
    assert set(old) == set(new)
    spans = secrets.judged_spans(before, ["source", "lang"], "source").where("live").collect()
    expected = dict(old)
    for i in {s.id for s in spans}:
        cover = [False] * len(old[i])
        for s in spans:
            if s.id == i:
                cover[s.start : s.end] = [True] * (s.end - s.start)
        marked = "".join("\0" if c else t for c, t in zip(cover, old[i]))
        expected[i] = re.sub("\0+", "[SECRET]", marked)
    assert {i: t or "" for i, t in expected.items()} == {i: t or "" for i, t in new.items()}
    assert all(r.n_chars == len(r.text or "") for r in after.collect())


def test_packing(stages):
    before, packed = stages["best-fit packing"]
    rows = packed.collect()
    assert {r.doc_id for r in rows} == set(texts(before))
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024


def test_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        frame = spark.read.parquet(f"{SMALL}/{name}.parquet")
        frame.where("false" if name == "documents" else "true").write.parquet(
            str(tmp_path / f"{name}.parquet")
        )
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
