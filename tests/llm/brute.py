"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import collections
import re
import zlib

import pandas as pd
import xxhash

SMALL, CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(name, sf=SMALL):
    return pd.read_parquet(f"{sf}/{name}.parquet")


def words(text):
    return WORD.findall(text or "")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def xx(*values):
    """Spark's xxhash64 of strings and longs."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def repeats(texts, width):
    """(words, kept words) of each text: a word goes if a window over it stands twice."""
    lists = [words(t) for t in texts]
    count = collections.Counter(tuple(w[i : i + width]) for w in lists for i in range(len(w) - width + 1))
    out = []
    for w in lists:
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                keep[i : i + width] = [False] * width
        out.append((w, [x for x, k in zip(w, keep) if k]))
    return out


def labelled_kmers(text, k=5):
    w = words(text)
    seen, out = collections.Counter(), []
    for i in range(max(1, len(w) - k + 1)) if w else []:
        gram = tuple(w[i : i + k])
        out.append((gram, seen[gram]))
        seen[gram] += 1
    return out


def classes(ids, texts, like=0.8):
    """Smallest id of each document's class: equal texts, and links of ordered k-mer similarity."""
    from bisect import bisect_left

    grams = [labelled_kmers(t) for t in texts]
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(ids)):
        place = {g: i for i, g in enumerate(grams[a])}
        for b in range(a + 1, len(ids)):
            if (texts[a] or "") == (texts[b] or ""):
                parent[find(a)] = find(b)
                continue
            hits = [place[g] for g in grams[b] if g in place]
            tails = []
            for t in hits:
                k = bisect_left(tails, t)
                tails[k : k + 1] = [t]
            s, n = len(tails), len(grams[a]) + len(grams[b])
            if s and s / (n - s) >= like:
                parent[find(a)] = find(b)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, x), x)
    return {x: least[find(i)] for i, x in enumerate(ids)}
