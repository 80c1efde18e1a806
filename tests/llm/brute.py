"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=5):
    w = SPACE_WORD.findall(low(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(pairs):
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {a: find(a) for a in parent}


def near_links(sets, percent):
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                yield i, j


def near_duplicates(docs, percent=85):
    """{doc_id: (n_shingles, component)}"""
    sets = {i: shingles(t) for i, t in docs.items()}
    parts = components(near_links(sets, percent))
    return {i: (len(s), parts.get(i, i)) for i, s in sets.items()}


def contamination(docs, items, window=13):
    """{doc_id: (n_words, hit positions, items)}"""
    phrases = defaultdict(set)
    for item, text in items:
        w = ALNUM_WORD.findall(low(text))
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            phrases[tuple(w[i : i + m])].add(str(item))
    lengths = {len(p) for p in phrases}
    out = {}
    for d, text in docs:
        w = ALNUM_WORD.findall(low(text))
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                p = tuple(w[i : i + m])
                if p in phrases:
                    hit.update(range(i, i + m))
                    found |= phrases[p]
        out[d] = (len(w), hit, sorted(found))
    return out
