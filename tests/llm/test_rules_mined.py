"""Mined URL rules against plain enumeration, and owned secrets against plain counts."""

from __future__ import annotations

import re
import time
from collections import defaultdict
from itertools import combinations

import pytest

from cardlake.llm import secrets, urlrules
from cardlake.llm.queries import QUERIES
from tests.llm import brute


def tokens(host, path):
    def parts(text, mark, cut):
        return {mark + t for t in re.split(cut, re.sub("[0-9]+", "#", text.lower())) if t}

    return frozenset(parts(host, "h:", r"[.\-_]") | parts(path, "p:", r"[/.\-_]"))


def plain_verdicts(urls, support=urlrules.MIN_SUPPORT, confidence=urlrules.MIN_CONFIDENCE):
    """(verdict, confidence) of unlisted places, by all rules over single tokens."""
    places = {brute.rule_and_place(u) for u in urls}
    listed = dict(urlrules.LISTED)
    rows = [(tokens(h, p), listed[r]) for h, p, r in places if r]
    least = support * len(rows)
    level = {frozenset([t]) for have, _ in rows for t in have}
    rules = {}
    while level:
        frequent = []
        for some in level:
            held = [v for have, v in rows if some <= have]
            if len(held) < least:
                continue
            frequent.append(some)
            for verdict in set(held):
                n = held.count(verdict)
                if n >= least and n / len(held) >= confidence:
                    rules[some, verdict] = (n / len(held), n / len(rows))
        grown = {a | b for a, b in combinations(frequent, 2) if len(a | b) == len(a) + 1}
        known = set(frequent)
        level = {g for g in grown if all(g - {t} in known for t in g)}
    kept = {
        (some, verdict): v
        for (some, verdict), v in rules.items()
        if not any(
            (frozenset(few), verdict) in rules and rules[frozenset(few), verdict][0] >= v[0]
            for size in range(1, len(some))
            for few in combinations(some, size)
        )
    }
    out = {}
    for host, path, rule in places:
        if rule is None:
            have = tokens(host, path)
            fits = [(*v, len(some), verdict) for (some, verdict), v in kept.items() if some <= have]
            best = max(fits, default=None)
            out[host, path] = (best[3], best[0]) if best else (urlrules.DEFAULT, None)
    return out


def judged(rows):
    return {(r.host, r.path): (r.verdict, r.confidence) for r in rows if r.rule is None}


def test_small_table(spark):
    hosts = ["a.com", "b-news.com", "example.com", "shop.net", "x.net", "a.org", "news.org", "b.org"]
    paths = ["/en/a/1", "/en/b/2", "/es/a", "/fr/b/shop", "/de/news/7", "/en/shop", "", "/es/", "/fr/news"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [f"http://t{i}.com/a/b/c" for i in range(9)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2, "page_id long, url string")
    for support, confidence in ((0.02, 0.8), (0.1, 0.6), (0.3, 1.0)):
        found = judged(
            urlrules.filtered_urls(pages, min_support=support, min_confidence=confidence).collect()
        )
        assert found == plain_verdicts(urls, support, confidence)
        assert support > 0.1 or {v for v, _ in found.values()} == {"allow", "block"}


def test_whole_table(spark, sf_dir, table):
    urls = [u for (u,) in table("pages", "url")]
    found = judged(QUERIES["op2_url_filters"](spark, sf_dir).collect())
    assert found == plain_verdicts(urls)


def test_common_tokens_of_a_template(spark):
    """Twenty tokens that go together are one item, not a million itemsets."""
    common = "/".join(f"part{chr(97 + i)}" for i in range(20))
    urls = [f"http://shop.net/{'es' if i % 2 else 'fr'}/{common}/x{chr(97 + i % 26)}" for i in range(1500)]
    urls += [f"http://site{i}.com/y{i % 7}" for i in range(500)]
    urls += [f"http://other.org/{common}", "http://other.org/parta", "http://other.org/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    begun = time.time()
    rows = {r.url: r for r in urlrules.filtered_urls(pages).collect()}
    assert time.time() - begun < 60
    assert rows[f"http://other.org/{common}"].verdict == "block"
    assert rows["http://other.org/parta"].verdict == "block"
    assert rows["http://other.org/q"].verdict == "allow"


KEY = "aB3dE5gH7jK9mN1pQ3sT5vW7x"


def live(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = secrets.judged_spans(docs, ["source", "lang"], "source", **options).collect()
    return {(r.id, r.kind) for r in found if r.live}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(1, KEY, "a", "en"), (2, KEY, "b", "en")], {1, 2}),  # one text, copied
        ([(1, KEY, "a", "en"), (2, "so " + KEY, "b", "en")], set()),  # two owners
        ([(1, KEY, "a", "en"), (2, "so " + KEY, "a", "de")], {1, 2}),  # two repositories
        ([(i, f"{i} {KEY}", "a", f"l{i}") for i in range(4)], set()),  # too many of them
        ([(1, KEY, None, None), (2, "so " + KEY, None, "en")], {1, 2}),
        ([(1, KEY, "a", "en"), (1, "so " + KEY, "b", "en"), (2, KEY, "b", "en")], set()),
    ],
)
def test_owners_of_distinct_texts(spark, rows, expected):
    assert live(spark, rows) == {(i, "mixed") for i in expected}
    assert live(spark, rows, max_owners=9, max_repositories=9) == {(r[0], "mixed") for r in rows}


def test_owned_spans_of_the_whole_table(spark, sf_dir, table):
    """Live spans by counting texts, owners and repositories in Python."""
    patterns = {k: (re.compile(p, re.A), n) for k, p, _, n in secrets.OWNED}
    base = {k: (re.compile(p), g, n) for k, p, g, n in secrets.BASE}
    texts, spans = {}, defaultdict(list)
    for doc_id, text, source, lang in table("documents", "doc_id, text, source, lang"):
        text = text or ""
        place = (source or "", f"{lang}")
        texts[text] = min(texts.get(text, place), place)
        for kind, (pattern, least) in patterns.items():
            for m in pattern.finditer(text):
                if len(m[0]) >= least:
                    spans[doc_id].append((kind, m.start(), m.end(), m[0], text))
        for kind, (pattern, group, least) in base.items():
            for m in pattern.finditer(text):
                if len(m[group]) >= least:
                    spans[doc_id].append((kind, None, None, m[group], text))
    holders = defaultdict(set)
    for found in spans.values():
        for *_, secret, text in found:
            holders[secret].add(texts[text])

    def looks_live(kind, secret):
        if len(set(secret)) < secrets.MIN_DISTINCT or len({o for o, _ in holders[secret]}) > 1:
            return False
        if len(holders[secret]) > secrets.MAX_REPOSITORIES:
            return False
        if kind == "mixed":
            return all(re.search(p, secret) for p in ("[0-9]", "[A-Z]", "[a-z]")) and not (
                re.fullmatch("[0-9a-f]+", secret)
            )
        return kind == "key" or bool(re.search("[0-9]", secret) and re.search("[A-Za-z]", secret))

    expected = {
        (i, kind, start, end)
        for i, found in spans.items()
        for kind, start, end, secret, _ in found
        if kind in patterns and looks_live(kind, secret)
    }
    rows = QUERIES["op3_secret_scans"](spark, sf_dir).collect()
    got = {
        (r.doc_id, k, int(s), int(e))
        for r in rows
        for k, s, e in (x.split(":") for x in r.spans.split(",") if x)
        if k in patterns
    }
    assert got == expected
    n_live = {
        i: sum(looks_live(kind, secret) for kind, _, _, secret, _ in found)
        for i, found in spans.items()
    }
    assert {r.doc_id: r.n_live for r in rows} == {r.doc_id: n_live.get(r.doc_id, 0) for r in rows}
    assert sum(n_live.values())
