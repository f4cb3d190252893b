"""Plain Python answers that the operators are held against."""

import hashlib
import re
from collections import defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}


def ascii_lower(text):
    return text.translate(LOWER)


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def contamination(docs, items, window):
    """docs: [(doc_id, text)], items: [(item_id, text)] -> [(doc_id, n_words, n_hit, n_items, sha, contaminated)]"""
    out = []
    grams = defaultdict(set)
    for i, t in items:
        w = bench_words(t)
        if w:
            for k in range(max(1, len(w) - window + 1)):
                grams[tuple(w[k : k + window])].add(i)
    lengths = {len(g) for g in grams}
    for d, t in docs:
        w = bench_words(t)
        hit, own = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit.update(range(k, k + n))
                    own |= grams[g]
        ids = sorted(str(x) for x in own if x is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)})


def components(docs, n, percent):
    """docs: [(doc_id, text)] -> {doc_id: (set size, component)}"""
    sets = {d: shingle_set(t, n) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by_shingle[x].append(d)
    for d, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for o in by_shingle[x]:
                if o < d:
                    shared[o] += 1
        for o, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[o]) - both):
                a, b = root(d), root(o)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}
