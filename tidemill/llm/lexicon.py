"""A minimal acyclic transducer of words: shared prefixes and suffixes, outputs that add up to a word's row.

``compile_lexicon`` builds the automaton from sorted words (one pass, equal
right languages are merged as soon as a word can no longer change them) and
lays it out in flat arrays. An arc's output is the number of words that sort
before every word through it, so the outputs along a word's path add up to
its row in the table of token ids. ``Lexicon`` memory-maps that layout and
looks up many words at once.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np


class _State:
    __slots__ = ("arcs", "final", "words", "number")

    def __init__(self) -> None:
        self.arcs: dict[int, _State] = {}
        self.final = False
        self.words = 0
        self.number = -1


def _minimal(words: list[bytes]) -> _State:
    root, register = _State(), {}
    path: list[_State] = [root]
    before = b""

    def settle(depth: int) -> None:
        """Replace the states below ``depth`` of the last word by equal ones met before."""
        while len(path) > depth + 1:
            state = path.pop()
            key = (state.final, tuple((c, id(s)) for c, s in state.arcs.items()))
            same = register.setdefault(key, state)
            if same is state:
                state.words = state.final + sum(s.words for s in state.arcs.values())
            else:
                path[-1].arcs[before[len(path) - 1]] = same

    for word in words:
        common = 0
        for a, b in zip(before, word, strict=False):
            if a != b:
                break
            common += 1
        settle(common)
        for c in word[common:]:
            state = _State()
            path[-1].arcs[c] = state
            path.append(state)
        path[-1].final = True
        before = word
    settle(0)
    root.words = root.final + sum(s.words for s in root.arcs.values())
    return root


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> bytes:
    """Bytes of the transducer and its id table; ``words`` are sorted and distinct, ``ids[i]`` belongs to ``words[i]``."""
    root = _minimal(words)
    states, todo = [root], [root]
    root.number = 0
    while todo:
        for s in todo.pop().arcs.values():
            if s.number < 0:
                s.number = len(states)
                states.append(s)
                todo.append(s)
    keys, targets, outputs = [], [], []
    for state in states:
        passed = int(state.final)
        for c, s in sorted(state.arcs.items()):
            keys.append(state.number << 8 | c)
            targets.append(s.number)
            outputs.append(passed)
            passed += s.words
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    ends = np.cumsum([0] + [len(x) for x in ids])
    arrays = [
        np.array(keys, np.int64)[order],
        np.array(targets, np.int32)[order],
        np.array(outputs, np.int32)[order],
        np.array([s.final for s in states], np.uint8),
        ends.astype(np.int64),
        np.array([i for x in ids for i in x], np.int32),
    ]
    head = np.array([max(map(len, words), default=0), *(a.nbytes for a in arrays)], np.int64)
    return head.tobytes() + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


class Lexicon:
    """The layout of ``compile_lexicon``, memory-mapped from an unlinked scratch file."""

    TYPES = (np.int64, np.int32, np.int32, np.uint8, np.int64, np.int32)

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as f:  # the mapping keeps the pages, nothing is left behind
            f.write(data)
            f.flush()
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(self._map, np.int64, 1 + len(self.TYPES))
        self.longest, at, arrays = int(head[0]), head.nbytes, []
        for size, kind in zip(head[1:].tolist(), self.TYPES, strict=True):
            arrays.append(np.frombuffer(self._map, kind, size // np.dtype(kind).itemsize, at))
            at += size + -size % 8
        self.keys, self.targets, self.outputs, self.final, self.ends, self.ids = arrays

    def rows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row of each word ``data[start:end]``, -1 where the lexicon lacks it."""
        n = len(starts)
        row, state = np.zeros(n, np.int64), np.zeros(n, np.int64)
        length = ends - starts
        out = np.full(n, -1, np.int64)
        alive = np.flatnonzero(length <= self.longest) if len(self.keys) else np.array([], np.int64)
        step = 0
        while len(alive):
            done = length[alive] == step
            ended = alive[done]
            hit = ended[self.final[state[ended]] == 1]
            out[hit] = row[hit]
            alive = alive[~done]
            if not len(alive):
                break
            key = state[alive] << 8 | data[starts[alive] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            there = self.keys[arc] == key
            alive, arc = alive[there], arc[there]
            state[alive] = self.targets[arc]
            row[alive] += self.outputs[arc]
            step += 1
        return out
