"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text, n=5):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + n]) for k in range(max(1, len(found) - n + 1)))


def jaccard_components(rows, threshold=75):
    """(size, component) of each row (id, text)."""
    sets = [shingles(t) for _, t in rows]
    union, where = Union(), defaultdict(list)
    for k, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True)):
        if doc_id is None or not s:
            continue
        union.find(doc_id)
        met = Counter(j for x in s for j in where[x])
        for j, shared in met.items():
            if 100 * shared >= threshold * (len(s) + len(sets[j]) - shared):
                union.join(doc_id, rows[j][0])
        for x in s:
            where[x].append(k)
    return [(len(s), doc_id if doc_id is None or not s else union.find(doc_id)) for (doc_id, _), s in zip(rows, sets, strict=True)]


def removed_words(rows, window=50):
    """(words, whether each is removed) of each row (id, text)."""
    found = [WORD.findall(t or "") for _, t in rows]
    owner = {}
    for (doc_id, _), w in zip(rows, found, strict=True):
        for k in range(len(w) - window + 1):
            if doc_id is not None:
                key = tuple(w[k : k + window])
                owner[key] = min(owner.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), w in zip(rows, found, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if doc_id is not None and owner[tuple(w[k : k + window])] < doc_id:
                gone[k : k + window] = [True] * window
        out.append((w, gone))
    return out
