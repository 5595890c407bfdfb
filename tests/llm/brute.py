"""Plain-Python versions of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_ids(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def quality_base(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


def _lines_apart(docs: list[tuple]) -> list[tuple[list[str], list[str]]]:
    """Lines and kept lines of each (doc_id, text)."""
    key = lambda x: x.strip(BLANKS).translate(LOW)
    holders = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(d)
    stays = lambda d, x: len(key(x)) < 20 or len(holders[key(x)] - {None}) < 3 or d == max(holders[key(x)] - {None})
    return [(lines := (t or "").split("\n"), [x for x in lines if stays(d, x)]) for d, t in docs]


def dedup_lines(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, sha) for (doc_id, text)."""
    apart = _lines_apart(docs)
    return [(d, len(x), len(x) - len(y), hashlib.sha256("\n".join(y).encode()).hexdigest()) for (d, _), (x, y) in zip(docs, apart, strict=True)]


def without_repeated_lines(docs: list[tuple]) -> list[tuple]:
    return [(d, t if t is None else "\n".join(y)) for (d, t), (_, y) in zip(docs, _lines_apart(docs), strict=True)]


def shingle_set(text: str | None, k: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def jaccard_components(docs: list[tuple], k: int = 3, num: int = 90, den: int = 100) -> list[tuple]:
    """(doc_id, n_shingles, component_id)."""
    sets = [(d, shingle_set(t, k)) for d, t in docs]
    at: dict = {d: d for d, _ in sets}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    by_gram = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            by_gram[g].append(i)
    for i, (d, s) in enumerate(sets):
        both = Counter(j for g in s for j in by_gram[g] if j > i)
        for j, n in both.items():
            if den * n >= num * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((root(d), root(sets[j][0])))
                at[b] = a
    return [(d, len(s), root(d)) for d, s in sets]
