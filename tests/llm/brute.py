"""Plain single-process versions of the operators, for small tables."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np


class Classes:
    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        self.parent[self.find(a)] = self.find(b)

    def least(self, ids):
        out = {}
        for i, name in enumerate(ids):
            root = self.find(i)
            out[root] = name if root not in out else min(out[root], name)
        return [out[self.find(i)] for i in range(len(ids))]


def sound(vector):
    return vector is not None and len(vector) > 0 and None not in vector and bool(np.isfinite(np.array(vector, float)).all())


def near_vectors(rows, threshold=0.98):
    """rows of (id, vector, label): sorted (id, links, component, kept)."""
    classes, links, groups = Classes(len(rows)), [0] * len(rows), defaultdict(list)
    for i, (_, v, label) in enumerate(rows):
        if label is not None and sound(v) and any(v):
            groups[label, len(v)].append(i)
    for own in groups.values():
        m = np.array([rows[i][1] for i in own], float)
        length = np.linalg.norm(m, axis=1)
        for a, b in zip(*np.nonzero(np.triu(m @ m.T / np.outer(length, length) >= threshold, 1))):
            links[own[a]] += 1
            links[own[b]] += 1
            classes.join(own[a], own[b])
    least = classes.least([r[0] for r in rows])
    return sorted((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, least))


def without_repeats(docs, window=35):
    """docs of (id, text): sorted (id, words, removed, digest of what is kept)."""
    words = [(t or "").encode().split() for _, t in docs]
    places = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if places[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), sha256(kept).hexdigest()))
    return sorted(out)


def shingles(text, n=5):
    w = (text or "").encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)])


def near_texts(docs, threshold=0.8):
    """docs of (id, text): sorted (id, class, kept)."""
    sets, classes, holders = [shingles(t) for _, t in docs], Classes(len(docs)), defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if n >= threshold * (len(s) + len(sets[j]) - n):
                classes.join(i, j)
        for x in s:
            holders[x].append(i)
    least = classes.least([d for d, _ in docs])
    return sorted((d, c, d == c) for (d, _), c in zip(docs, least))


def top_products(rows, every=50, k=5):
    ok = [(i, np.floor(256 * np.array(v, float))) for i, v, _ in rows if sound(v)]
    ids, m = np.array([i for i, _ in ok]), np.array([v for _, v in ok])
    out = []
    for q in np.flatnonzero(ids % every == 0):
        score = (m @ m[q]).astype(int)
        best = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out += [(int(ids[q]), n + 1, int(ids[j]), int(score[j])) for n, j in enumerate(best)]
    return sorted(out)


def check_packing(pieces, ids_of, size):
    """pieces as dicts with ids; ids_of: expected ids of each (doc, text) row. Returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4 > 0
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc_id, expected in ids_of.items():
        got, at = [], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(expected)
            got += np.frombuffer(bytes(p["ids"]), "<u4").tolist()
            at += p["length"]
        assert got == expected
    assert set(by_doc) == set(ids_of)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
    return 1 - sum(p["length"] for p in pieces) / (size * max(1, len(by_sequence)))
