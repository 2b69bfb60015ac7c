"""Brute-force versions of the text operators, shared by the tests."""

import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    return groups


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {**out, **share}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def brute_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    parts = [" ".join(words)] if len(words) < k else [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    h = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=2):
    fps = sorted(set(fps))
    arr = np.array(fps, dtype=np.uint64)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, f in enumerate(fps):
        near = np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= bits)
        for j in near:
            root[find(fps[i + 1 + j])] = find(f)
    return {f: find(f) for f in fps}
