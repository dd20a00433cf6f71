"""The operators' contracts, spelled out the slow way."""

from __future__ import annotations

import hashlib
from collections import Counter

import xxhash


def words_kept(texts, length):
    """Per text: words, removed words, digest of the rest."""
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def bytes_kept(texts, length):
    """Per text, in order: bytes, removed bytes, removed runs, digest of the rest."""
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(b[i : i + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    found = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def components(fingerprints, ids):
    """Smallest id reachable over links of at most three bits."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fingerprints[i] ^ fingerprints[j]).count("1") <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]


def shingles(text, k=5):
    plain = "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text or "")
    w = "".join(c.lower() if c.isascii() else c for c in plain).split()
    k = min(k, len(w))
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
