"""Plain forms of the operators' results, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    kinds = [
        (
            "assign",
            r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            2,
            6,
        ),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ]
    found = []
    for no, (kind, pattern, group, least) in enumerate(kinds):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), no, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(found)]


def edited_texts(docs: list[tuple[int, str]]) -> dict[int, tuple[int, str]]:
    docs = sorted(docs)
    out = {}
    for k, (i, text) in enumerate(docs):
        other = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        out[i] = (len(text), text[: len(text) - half] + other[:half])
    return out


def five_word_runs(text: str | None) -> list[tuple[str, ...]]:
    w = re.split(r"[\x20\x09-\x0D]+", (text or "").strip(" \t\n\x0b\f\r"))
    return [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))]


def five_word_terms(text: str | None) -> set[tuple[str, ...]]:
    return set(five_word_runs(text))


def revisits(pages: list[tuple[int, str | None]]) -> dict[int, tuple]:
    newest = defaultdict(int)
    for i, html in pages:
        newest[html or ""] = max(newest[html or ""], i)
    out = {}
    for i, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        target = newest[html or ""]
        out[i] = (
            (len(raw), digest, "response", None)
            if i == target
            else (len(raw), digest, "revisit", target)
        )
    return out


def contamination(docs, items) -> dict[int, tuple]:
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    windows = defaultdict(set)
    for i, text in items:
        w = words(text)
        for j in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[j : j + 13])].add(i)
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        names = ",".join(sorted(map(str, found)))
        out[i] = (len(w), len(hit), len(found), sha(names), bool(hit) and 20 * len(hit) >= len(w))
    return out


def rule_and_place(url: str | None) -> tuple[str, str, str | None]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
    best = None
    for rule in ("com/", "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/"):
        domain, slash, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith(slash + rest):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not w:
        return set()
    return {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))}


def components(docs) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] += 1
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeats(docs, least: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, text in sorted((i, (t or "").encode()) for i, t in docs):
        gone = bytearray(len(text))
        for j in range(len(text) - least + 1):
            key = hashlib.blake2b(text[j : j + least], digest_size=16).digest()
            if key in seen:
                gone[j : j + least] = b"\1" * least
            else:
                seen.add(key)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out[i] = (len(text), sum(gone), runs, sha(kept))
    return out


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
