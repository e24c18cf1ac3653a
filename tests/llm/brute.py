"""Plain versions of operators for small inputs."""

import re
from collections import Counter

import xxhash


def without_repeats(texts, window=400):
    """Per text (bytes): kept bytes, removed bytes and spans."""
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        out.append((bytes(b for b, g in zip(t, gone, strict=True) if not g), sum(gone), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))))
    return out


def simhash(text):
    words = bytes(text or "", "utf-8").lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """For each fingerprint of a list the smallest index in its component."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def similar_groups(texts, k=5, least=0.8):
    """For each text the smallest index that a chain of shingle sets of the least similarity leads to."""
    sets = [set(zip(*[(t or "").lower().split()[i:] for i in range(k)], strict=False)) or {tuple((t or "").lower().split())} for t in texts]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= least * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def without_long_repeats(texts, window=400, words=51):
    """Per text (bytes) what is left without repeated strings of ``window`` bytes and repeated passages of ``words`` words."""
    spans = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", t)] for t in texts]
    tokens = [t.split() for t in texts]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    seen_words = Counter(tuple(w[i : i + words]) for w in tokens for i in range(len(w) - words + 1))
    out = []
    for t, w, s in zip(texts, tokens, spans, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        for i in range(len(w) - words + 1):
            if seen_words[tuple(w[i : i + words])] > 1:
                a, b = s[i][0], s[i + words - 1][1]
                gone[a:b] = [True] * (b - a)
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out
