"""Each query over its whole table against a plain form."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardlake.llm import fingerprints
from cardlake.llm.packing import best_fit, cut
from cardlake.llm.queries import QUERIES
from tests.llm import brute


@pytest.fixture(scope="session")
def result(spark, sf_dir):
    kept = {}

    def rows(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, sf_dir).collect()
        return kept[name]

    return rows


def test_packing(result, table):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, lengths = {}, []
    for doc_id, text in table("documents", "doc_id, text"):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for piece, (start, n) in enumerate(cut(len(ids), 1024)):
            raw = np.array(ids[start : start + n], "<u4").tobytes()
            expected[doc_id, piece] = (start, n, zlib.crc32(raw))
            lengths.append(n)
    rows = result("op1_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    end = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
    assert max(end.values()) <= 1024
    counts = {n: lengths.count(n) for n in set(lengths)}
    assert len(end) == best_fit(counts, 1024)[1]


def test_url_filters(result, table):
    rows = {r.page_id: r for r in result("op2_url_filters")}
    listed = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow",
              "net/es/": "block", "net/fr/": "block"}
    for page_id, url in table("pages", "page_id, url"):
        host, path, rule = brute.rule_and_place(url)
        row = rows.pop(page_id)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == listed[rule] if rule else row.verdict in ("allow", "block")
    assert not rows


def test_secret_scans(result, table):
    rows = {r.doc_id: r for r in result("op3_secret_scans")}
    some = 0
    for doc_id, text in table("documents", "doc_id, text"):
        spans = brute.base_spans(text or "")
        row = rows.pop(doc_id)
        count = [sum(k == kind for *_, k in spans) for kind in ("assign", "access", "hex")]
        assert [row.n_assign, row.n_access, row.n_hex] == count
        base = [f"{k}:{s}:{e}" for s, e, k in spans]
        assert row.base_sha256 == brute.sha(",".join(base))
        assert [x for x in row.spans.split(",") if x.split(":")[0] in ("assign", "access", "hex")] == base
        some += len(base)
    assert some and not rows


def test_warc(result, table):
    expected = brute.revisits(table("pages", "page_id, html"))
    rows = result("op4_warc")
    assert {r.page_id: tuple(r)[1:] for r in rows} == expected
    assert len(rows) == len(expected)


def test_fingerprints(result, table):
    docs = [(i, t or "") for i, t in table("documents", "doc_id, text")]
    expected = brute.edited_texts(docs)
    rows = result("op5_fingerprints")
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == {
        i: (n, brute.sha(t)) for i, (n, t) in expected.items()
    }
    assert len(rows) == len(expected)
    texts, by_text = dict(docs), {}
    for r in rows:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    order = sorted(rows, key=lambda r: r.doc_id)
    for r, after in zip(order, order[1:] + order[:1], strict=True):
        apart = bin(int(r.fingerprint, 16) ^ int(after.fingerprint, 16)).count("1")
        assert r.near_next == 1 - apart / 128
        apart = bin(int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).count("1")
        assert r.near_edited == 1 - apart / 128
        if r.doc_id % 50 == 0:
            near = sum(
                bin(int(r.fingerprint, 16) ^ int(x.fingerprint, 16)).count("1") <= fingerprints.RADIUS
                for x in rows
            )
            assert r.n_near == near - 1
        else:
            assert r.n_near is None
    long = [r for r in rows if r.n_chars > 400]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.9


def test_near_copies_against_jaccard(result, table):
    """All documents of Jaccard 0.8 or more are counted, not only those within 3 bits."""
    sets = {i: brute.five_word_terms(t) for i, t in table("documents", "doc_id, text")}
    rows = {r.doc_id: r for r in result("op5_fingerprints")}
    for i, mine in sets.items():
        if i % 50:
            assert rows[i].n_alike is None
            continue
        n = sum(100 * len(mine & other) >= 80 * len(mine | other) for other in sets.values()) - 1
        assert rows[i].n_alike == n
    assert rows and any(r.n_alike for r in rows.values())


def simhash(text, hashes):
    """Plain votes over all terms of a text, repeats counted."""
    terms = brute.five_word_runs(text)
    votes = [sum((hashes[t] >> b) & 1 for t in terms) * 2 > len(terms) for b in range(127, -1, -1)]
    return f"{int(''.join('01'[v] for v in votes), 2):032x}"


def test_fingerprint_is_a_plain_simhash(spark):
    texts = [None, " ", "a b", "a b c d e", "x y " * 300, " ".join(f"w{j % 37}" for j in range(900))]
    runs = {run for t in texts for run in brute.five_word_runs(t)}
    frame = spark.createDataFrame(
        [(list(r) + [None] * (5 - len(r)),) for r in runs], "run array<string>"
    )
    h0 = F.xxhash64(*[F.get("run", F.lit(j)) for j in range(5)])
    found = frame.select("run", h0.alias("h0"), F.xxhash64(h0, F.lit(1)).alias("h1")).collect()
    low = (1 << 64) - 1
    hashes = {
        tuple(w for w in r.run if w is not None): (r.h0 & low) << 64 | (r.h1 & low) for r in found
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = fingerprints.fingerprinted(docs, "text", ["id"], []).collect()
    assert {r.id: r.fingerprint for r in rows} == {
        i: simhash(t, hashes) for i, t in enumerate(texts)
    }


@pytest.mark.parametrize(("radius", "flips"), [(0, 0), (3, 0), (10, 1), (23, 2), (29, 2), (31, 3)])
def test_radius_search_loses_nothing(spark, radius, flips):
    """Every distance up to the radius and beyond, copies, nulls, the highest bits set."""
    rng = np.random.default_rng(radius)
    values = [None, "0" * 32, "f" * 32, "f" * 32, "8" + "0" * 31]
    for _ in range(12):
        start = int.from_bytes(rng.bytes(16), "big")
        for apart in range(0, radius + 4):
            bits = rng.choice(128, apart, replace=False)
            values.append(f"{start ^ sum(1 << int(b) for b in bits):032x}")
    # all differences in one block, then spread evenly
    values += [f"{(1 << radius) - 1:032x}", f"{sum(1 << (4 * b) for b in range(radius)):032x}"]
    points = spark.createDataFrame([(v,) for v in values], "fingerprint string")
    asked = points.limit(len(values)).where("fingerprint is null or hash(fingerprint) % 3 <> 0")
    given = [r.fingerprint for r in asked.collect()]
    counts = Counter(v for v in values if v is not None)
    expected = set()
    for a in {v for v in given if v is not None}:
        for b, n in counts.items():
            d = (int(a, 16) ^ int(b, 16)).bit_count()
            if d <= radius:
                expected.add((a, b, d, n))
    rows = fingerprints.within_radius(asked, points, radius, flips=flips).collect()
    assert len(rows) == len(expected)
    assert {tuple(r) for r in rows} == expected


def test_radius_holds_near_copies(spark):
    """Recall of the radius against brute force: pairs of Jaccard 0.8 and more."""
    rng = np.random.default_rng(5)
    docs = []
    for k in range(150):
        words = [f"k{k}w{j}" for j in range(int(rng.integers(80, 400)))]
        start, changed = int(rng.integers(0, 20)), max(1, len(words) * int(rng.integers(1, 11)) // 100)
        other = words[:start] + [f"x{j}" for j in range(changed)] + words[start + changed :]
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    frame = spark.createDataFrame(docs, "id long, text string")
    prints = fingerprints.fingerprinted(frame, "text", ["id"], [])
    by_print = {r.fingerprint: r.id for r in prints.collect()}
    found = {
        (by_print[r.fingerprint], by_print[r.near])
        for r in fingerprints.within_radius(prints, prints).collect()
    }
    sets = {i: brute.five_word_terms(t) for i, t in docs}
    alike = [
        (i, i + 1)
        for i in range(0, 300, 2)
        if 100 * len(sets[i] & sets[i + 1]) >= 80 * len(sets[i] | sets[i + 1])
    ]
    assert len(alike) > 50
    assert np.mean([pair in found for pair in alike]) >= 0.9


def test_near_copies_beyond_the_radius(spark):
    """Likeness on both sides of 0.8, with a passage that all texts hold."""
    hot = [f"h{j}" for j in range(60)]
    docs = [(0, None), (1, " "), (2, "a b"), (3, "a b c")]
    for k in range(30):
        words = [f"k{k}w{j}" for j in range(200)]
        changed = words[: 200 - 12 - k] + [f"x{j}" for j in range(12 + k)]
        docs += [(10 * k + 10, " ".join(hot + words)), (10 * k + 11, " ".join(hot + changed)),
                 (10 * k + 12, " ".join(hot + words))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    counts = {r.key: r.n_alike for r in fingerprints.alike_counts(frame, frame).collect()}
    keys = frame.select("doc_id", fingerprints.text_key(frame["text"]).alias("key")).collect()
    sets = {i: brute.five_word_terms(t) for i, t in docs}
    expected = {
        i: sum(100 * len(a & b) >= 80 * len(a | b) for b in sets.values()) for i, a in sets.items()
    }
    assert {r.doc_id: counts[r.key] for r in keys} == expected
    assert {1, 2, 3} <= set(expected.values())


def test_decontamination(result, table):
    expected = brute.contamination(
        table("documents", "doc_id, text"), table("benchmark", "item_id, text")
    )
    rows = result("op10_decontamination")
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected
    assert len(rows) == len(expected) and any(r.contaminated for r in rows)


def test_quality(result, table):
    rows = {r.doc_id: r for r in result("op8_quality")}
    assert all(r.held_out == brute.held_out(i) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = [(rows[i], q) for i, q in table("labels", "doc_id, quality") if brute.held_out(i)]
    assert labels and np.mean([r.predicted == q for r, q in labels]) > 0.9


def test_chat(result, table):
    dialogues = {}
    for conv, turn, role, text in sorted(table("conversations", "conv_id, turn, role, text")):
        dialogues.setdefault(conv, []).append((role, text))
    expected = {}
    for conv, turns in dialogues.items():
        for speaker in {r for r, _ in turns} - {"system"}:
            out, spans = "", []
            for role, text in turns:
                shown = role if role == "system" else "assistant" if role == speaker else f"user name={role}"
                out += f"<|im_start|>{shown}\n"
                start = len(out)
                out += text.replace("<|", "< |") + "<|im_end|>\n"
                if role == speaker:
                    spans.append(f"{start}-{len(out)}")
            expected[conv, speaker] = (len(turns), out, ",".join(spans))
    rows = result("op7_chat")
    assert {(r.conv_id, r.speaker): (r.n_turns, r.rendered, r["mask"]) for r in rows} == expected
    assert len(rows) == len(expected)


def test_jaccard_join(result, table):
    expected = brute.components(table("documents", "doc_id, text"))
    rows = result("op6_jaccard_join")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert len(rows) == len(expected)


def test_suffix_dedup(result, table):
    expected = brute.repeats(table("documents", "doc_id, text"))
    rows = result("op9_suffix_dedup")
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected
    assert len(rows) == len(expected) and any(r.n_spans > 1 for r in rows)
