"""Word and window hashes of a batch of texts, vectorised over its bytes.

A text's words are its runs of bytes other than ASCII white space. A word's
hash is a polynomial over a random byte table (modulo 2**64), read off prefix
sums, so that equal words have equal hashes wherever they stand; a window's
hash is the same over word hashes.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18  # bytes hashed at once; a word longer than this is hashed on its own

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words(NamedTuple):
    """Words of a slice of texts: byte ranges, and ``ends[i]:ends[i + 1]`` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    ends: np.ndarray

    def docs(self) -> np.ndarray:
        """Text index of each word."""
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array) -> Words:
    """Words of a string array without nulls."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(n + 1, np.int64))
    space = _SPACE[data]
    edge = np.ones(len(data) + 1, bool)  # edge[i]: something ends before byte i
    edge[1:-1] = space[:-1]
    edge[offsets] = True
    start = np.flatnonzero(edge[:-1] & ~space)
    edge[:-1] = space
    edge[offsets] = True
    stop = np.flatnonzero(edge[1:] & ~space) + 1
    return Words(data, start, stop, np.searchsorted(start, offsets))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Two hashers with different seeds are independent."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.key = hashlib.blake2b(b"%d" % seed, digest_size=16).digest()
        self._up, self._down = _powers(self.base & (1 << 64) - 1, BLOCK), _powers(self.inverse, BLOCK)
        self.base &= (1 << 64) - 1

    def words(self, w: Words) -> np.ndarray:
        """64-bit hash of each word."""
        out, at, n = np.empty(len(w.start), np.uint64), 0, len(w.start)
        while at < n:
            to = int(np.searchsorted(w.stop, w.start[at] + BLOCK, side="right"))
            if to <= at:
                long = w.data[w.start[at] : w.stop[at]].tobytes()
                out[at] = int.from_bytes(hashlib.blake2b(long, key=self.key, digest_size=8).digest(), "little")
                at += 1
                continue
            a, b = w.start[at:to] - w.start[at], w.stop[at:to] - w.start[at]
            sums = np.zeros(int(b[-1]) + 1, np.uint64)
            np.cumsum(self.table[w.data[w.start[at] : w.stop[to - 1]]] * self._up[: b[-1]], out=sums[1:])
            out[at:to] = mix((sums[b] - sums[a]) * self._down[a] + (b - a).astype(np.uint64))
            at = to
        return out

    def windows(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """Hash of each run of ``width`` hashes, by its first; the caller leaves out runs that cross texts."""
        n = len(hashes)
        if n < width:
            return np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _powers(self.base, n), out=sums[1:])
        return mix((sums[width:] - sums[:-width]) * _powers(self.inverse, n)[: n - width + 1])


def inside(ends: np.ndarray, width: int) -> np.ndarray:
    """Which of the runs of ``width`` words that ``Hasher.windows`` hashes lie in one text."""
    n = int(ends[-1])
    if n < width:
        return np.zeros(0, bool)
    stop = np.repeat(ends[1:], np.diff(ends))
    return np.arange(n - width + 1) + width <= stop[: n - width + 1]
