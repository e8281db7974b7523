"""Operator 8. Substring dedup by fixed-block anchors.

A word is removed if some window of ``width`` words over it has a sequence
that also starts anywhere else. Each text's non-overlapping blocks of
``(width + 1) // 2`` words, counted from its start, are the reference index;
any window holds exactly one whole block of its own text. The index is probed
with every rolling window of block length of every text. A window can only be
repeated if its block was found elsewhere, so the hits are extended: the
windows over a hit are looked up exactly (128-bit hashes), and runs of
repeated windows are the maximal exact repeats.

How it is dealt out. Rolling windows never travel as rows: a chunk of texts
sends, for each hash range, its distinct window hashes as one packed blob,
about two bytes a window, and its blocks with the text to tell. What is
already repeated inside a chunk is settled there and only reported once to
the others, so a passage shared by a third of all texts costs a range one
entry a chunk. Ranges grow in number with the input, not in size. Where there
are so many that a chunk would leave a range a few windows only, it deals to
groups of neighbouring ranges; what many chunks send to a group is merged, and
dealt to its ranges from there.

Defined cases: null and empty texts have no words; texts shorter than a
window lose nothing; fully equal rows count as two places; an empty table
gives an empty result; other columns are carried untouched, and result
columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DataType, StructType

from tidemill.llm.common import kept, open_table, released, stored, text_column, text_slices
from tidemill.llm.wordhash import Hasher, Words, inside, split_words

WIDTH = 35
CHUNK = 500_000  # windows gathered before a chunk is sent; bounds a Python worker's memory
RANGE_BYTES = 24 << 20  # text a hash range stands for
LEAST = 1_000  # windows a chunk's blob holds on average; a chunk deals to groups of ranges where single ranges would get fewer
MERGED = 8 * CHUNK  # windows merged at once before they go on from a group to its ranges
PLACES = 20_000  # shuffle partitions at most; beyond, a partition holds several ranges, one after another


def _hasher(seed: int) -> Hasher:
    made = kept(__name__)
    if seed not in made:
        made[seed] = Hasher(seed)
    return made[seed]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed where that is shorter; small numbers and small steps cost few bytes."""
    out = zstandard.ZstdCompressor(level=1)
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        data = min(planes, out.compress(planes), key=len)
        parts.append(len(a).to_bytes(4, "little") + len(data).to_bytes(4, "little") + data)
    return b"".join(parts)


def unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    back, at, out = zstandard.ZstdDecompressor(), 0, []
    for kind in kinds:
        n, size = int.from_bytes(data[at : at + 4], "little"), int.from_bytes(data[at + 4 : at + 8], "little")
        width = np.dtype(kind).itemsize
        planes = data[at + 8 : at + 8 + size]
        if size < n * width:
            planes = back.decompress(planes, max_output_size=n * width)
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).reshape(-1).view(kind))
        at += 8 + size
    return out


def _runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(id, start, stop) of each run of equal ids."""
    at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])[: len(ids)])
    return list(zip(ids[at].tolist(), at.tolist(), np.append(at, len(ids))[1:].tolist(), strict=True))


def _fan(ranges: int) -> int:
    """Neighbouring ranges that a chunk deals to as one group; 1 while single ranges get enough windows."""
    return -(-ranges * LEAST // CHUNK)


def _part(chunk: int, fan: int) -> int:
    """Which of a group's ``fan`` mergers a chunk of this task sends to."""
    task = TaskContext.get()
    return ((task.partitionId() if task else 0) + chunk) % fan


def _steps(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=sorted_.dtype.type(0))


def _ranged(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Hash range in the upper half, 32 more bits of the hash in the lower."""
    return ((hashes >> np.uint64(32)) % np.uint64(ranges)) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


_MESSAGE = "r_range int, r_dest int, r_blob binary"
_FOUND = "r_key long, r_vals array<long>"


def _message(ranges: list[int], dests: list, blobs: list) -> pa.RecordBatch:
    """Blobs for a hash range to work on (no dest), or findings it passes on to where a text's findings meet."""
    return pa.RecordBatch.from_arrays(
        [pa.array(ranges, pa.int32()), pa.array(dests, pa.int32()), pa.array(blobs, pa.binary())], names=["r_range", "r_dest", "r_blob"]
    )


def _findings(owner: np.ndarray, value: np.ndarray, ranges: int) -> tuple[list[int], list[bytes]]:
    """(dest, packed owners and values): one blob for each place where texts' findings meet."""
    dest = owner % ranges
    order = np.argsort(dest, kind="stable")
    some = _runs(dest[order])
    return [r for r, _, _ in some], [pack(owner[k], value[k].astype(np.int64)) for k in (order[a:b] for _, a, b in some)]


def _settled(owner: np.ndarray, value: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    if len(owner):
        dests, blobs = _findings(owner, value, ranges)
        yield _message(dests, dests, blobs)


def _by_range(work):
    """``work`` on each range's (or group's) blobs, which stand together; findings under way are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            on = []
            for rng, dest, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if dest is not None:
                    on.append((rng, dest, blob))
                    continue
                if rng != now and held:
                    yield from work(now, held)
                    held = []
                now = rng
                held.append(blob)
            if on:
                yield _message(*map(list, zip(*on, strict=True)))
        if held:
            yield from work(now, held)

    return run


def _matched(match, ranges: int):
    """Work of one hash range: ``match`` turns its blobs into (owners, values), which go where a text's findings meet."""

    def work(rng: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        dests, found = _findings(*match(rng, blobs), ranges)
        if dests:
            yield _message([rng] * len(dests), dests, found)

    return work


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All findings of some texts -> one row a text with its distinct values; the blobs of a place stand together."""
    now, held = None, []
    for batch in batches:
        for dest, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if dest != now and held:
                yield from _gathered(held)
                held = []
            now = dest
            held.append(blob)
    if held:
        yield from _gathered(held)


def _gathered(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    owner, value = zip(*(unpack(blob, np.int64, np.int64) for blob in blobs), strict=True)
    owners, values = np.concatenate(owner), np.concatenate(value)
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    keep = np.concatenate([[True], (np.diff(owners) != 0) | (np.diff(values) != 0)])
    owners, values = owners[keep], values[keep]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(owners)) + 1])
    ends = np.append(starts[1:], len(owners))
    for at in range(0, len(starts), 1000):
        a, b = starts[at], ends[min(at + 1000, len(starts)) - 1]
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts[at : at + 1000], b) - a, pa.int32()), pa.array(values[a:b]))
        yield pa.RecordBatch.from_arrays([pa.array(owners[starts[at : at + 1000]]), lists], names=["r_key", "r_vals"])


def _probe_chunk(ranges: int, fan: int, part: int, keys: list, found: list) -> Iterator[pa.RecordBatch]:
    """Messages of one chunk. ``found``: (ranged hash of each window, text of each block, ranged hash of each block)."""
    windows = np.concatenate([f[0] for f in found])
    block, owner = np.concatenate([f[2] for f in found]), np.concatenate([f[1] for f in found])
    yield from _deal_blocks(windows, np.zeros(len(windows), bool), block, np.array(keys, np.int64)[owner], ranges, fan, part)


def _deal_blocks(
    windows: np.ndarray, many: np.ndarray, block: np.ndarray, owner: np.ndarray, ranges: int, fan: int, part: int
) -> Iterator[pa.RecordBatch]:
    """Windows (``many``: known to stand twice) and blocks with their texts -> what is settled here, and one blob a group of ``fan`` ranges."""
    if not len(windows):
        return
    order = np.argsort(windows) if many.any() else None
    windows = np.sort(windows) if order is None else windows[order]
    at = np.flatnonzero(np.concatenate([[True], windows[1:] != windows[:-1]]))
    distinct, twice = windows[at], np.diff(np.append(at, len(windows))) > 1
    many = twice if order is None else twice | np.logical_or.reduceat(many[order], at)
    here = many[np.searchsorted(distinct, block)] if len(block) else np.zeros(0, bool)
    yield from _settled(owner[here], block[here].astype(np.int64), ranges)
    block, owner = block[~here], owner[~here]
    order = np.argsort(block, kind="stable")
    block, owner = block[order], owner[order]
    span = np.uint64(fan << 32)
    kind = np.uint32 if fan == 1 else np.uint64
    ids, blobs = [], []
    for group, a, b in _runs(distinct // span):
        base = np.uint64(group) * span
        c, d = np.searchsorted(block, np.array([base, base + span], np.uint64)).tolist()
        told, name = np.unique(owner[c:d], return_inverse=True)
        ids.append(group * fan + part)
        blobs.append(pack(_steps((distinct[a:b] - base).astype(kind)), np.packbits(many[a:b]), _steps((block[c:d] - base).astype(kind)), name.astype(np.uint32), told))
    yield _message(ids, [None] * len(ids), blobs)


def _merge_blocks(ranges: int, fan: int):
    """Work of one merger: what many chunks sent to a group of ranges, as if they were one chunk, dealt to the ranges."""
    kinds = (np.uint64, np.uint8, np.uint64, np.uint32, np.int64)

    def work(merger: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        base = np.uint64((merger // fan * fan) << 32)
        got, held = [], 0
        for i, blob in enumerate(blobs):
            steps, many, block, name, told = unpack(blob, *kinds)
            windows = base + np.cumsum(steps, dtype=np.uint64)
            got.append((windows, np.unpackbits(many, count=len(windows)).astype(bool), base + np.cumsum(block, dtype=np.uint64), told[name]))
            held += len(windows)
            if held >= MERGED or i == len(blobs) - 1:
                yield from _deal_blocks(*(np.concatenate([g[k] for g in got]) for k in range(4)), ranges, 1, 0)
                got, held = [], 0

    return work


def _probes(width: int, ranges: int, fan: int):
    """texts -> messages: every rolling window of block length, and the blocks."""
    size = (width + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        found: list = []
        held = chunk = 0
        for batch in batches:
            texts, names = text_column(batch, "r_text"), batch.column(batch.schema.get_field_index("r_key"))
            for a, b in text_slices(texts):
                w = split_words(texts.slice(a, b - a))
                long = np.diff(w.ends) >= width  # only these have windows at all
                ok = inside(w.ends, size)
                docs = w.docs()[: len(ok)]
                ok &= long[docs] if len(ok) else ok
                hashes = _ranged(_hasher(1).windows(_hasher(1).words(w), size), ranges)
                at = np.arange(len(ok)) - w.ends[docs]
                block = ok & (at % size == 0)
                found.append((hashes[ok], docs[block] + len(keys), hashes[block]))
                keys += names.slice(a, b - a).to_pylist()
                held += int(ok.sum())
                if held >= CHUNK:
                    yield from _probe_chunk(ranges, fan, _part(chunk, fan), keys, found)
                    keys, found, held, chunk = [], [], 0, chunk + 1
        if held:
            yield from _probe_chunk(ranges, fan, _part(chunk, fan), keys, found)

    return run


def _match_blocks(rng: int, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One hash range: index its blocks, probe them with all its windows, tell the texts whose blocks stand twice."""
    kinds = (np.uint32, np.uint8, np.uint32, np.uint32, np.int64)
    block, owner = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for blob in blobs:
        _, _, steps, name, told = unpack(blob, *kinds)
        block.append(np.cumsum(steps, dtype=np.uint32))
        owner.append(told[name])
    blocks, owners = np.concatenate(block), np.concatenate(owner)
    index = np.unique(blocks)
    count = np.zeros(len(index), np.int64)
    for blob in blobs if len(index) else []:
        steps, many = unpack(blob, *kinds[:2])
        probe = np.cumsum(steps, dtype=np.uint32)
        at = np.searchsorted(index, probe)
        at[at == len(index)] = 0
        hit = index[at] == probe
        count[at[hit]] += 1 + np.unpackbits(many, count=len(probe))[hit]
    twice = count[np.searchsorted(index, blocks)] > 1 if len(blocks) else np.zeros(0, bool)
    return owners[twice], blocks[twice].astype(np.int64) | rng << 32


def _kept(w: Words, keep: np.ndarray) -> list[bytes]:
    """Each text's kept words, joined by one space."""
    data = np.append(w.data, np.uint8(32))
    start, size = w.start[keep], (w.stop - w.start)[keep] + 1
    ends = np.concatenate([[0], np.cumsum(size)])
    out = data[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
    out[ends[1:] - 1] = 32
    raw = out.tobytes()
    per = np.concatenate([[0], np.cumsum(keep)])[w.ends]
    return [raw[ends[a] : max(ends[a], ends[b] - 1)] for a, b in zip(per, per[1:], strict=False)]


def _with(batch: pa.RecordBatch, drop: tuple[str, ...], **more: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + list(more.values()), names=names + list(more))


def _hit_blocks(width: int, ranges: int, digest: bool):
    """texts and their repeated block hashes -> where those blocks start; a text without any needs no more than its digest."""
    size = (width + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zipped = batch.column(batch.schema.get_field_index("r_zip")).to_pylist()
            texts = _text_array(zipped)
            lists = batch.column(batch.schema.get_field_index("r_vals")).to_pylist()
            for a, b in text_slices(texts):
                w = split_words(texts.slice(a, b - a))
                starts: list = [None] * (b - a)
                some = [i for i in range(a, b) if lists[i]]
                if some:
                    hashes = _ranged(_hasher(1).windows(_hasher(1).words(w), size), ranges).astype(np.int64)
                    for i in some:
                        at = np.arange(w.ends[i - a], w.ends[i - a + 1] - size + 1, size)
                        at = at[np.isin(hashes[at], np.array(lists[i], np.int64))] - w.ends[i - a]
                        starts[i - a] = at.astype(np.int32) if len(at) else None
                shas: list = [None] * (b - a)
                if digest:
                    kept = _kept(w, np.ones(len(w.start), bool))
                    shas = [hashlib.sha256(k).hexdigest() if s is None else None for k, s in zip(kept, starts, strict=True)]
                yield _with(
                    batch.slice(a, b - a),
                    ("r_zip", "r_vals", "r_key"),
                    r_words=pa.array(np.diff(w.ends), pa.int64()),
                    r_starts=pa.array(starts, pa.list_(pa.int32())),
                    r_zip=pa.array([z if h is None else None for z, h in zip(zipped[a:b], shas, strict=True)], pa.binary()),
                    r_sha=pa.array(shas, pa.string()),
                )

    return run


def _text_array(zipped: list) -> pa.Array:
    back = zstandard.ZstdDecompressor()
    texts = pa.array([b"" if z is None else back.decompress(z) for z in zipped], pa.binary())
    return pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)


def _window_chunk(ranges: int, fan: int, part: int, found: list) -> Iterator[pa.RecordBatch]:
    """``found``: (two hashes of each window, its text, its place, known to stand twice) -> what is settled here, and one blob a group of ranges."""
    one, two, owner, at, many = (np.concatenate([f[i] for f in found]) for i in range(5))
    if not len(one):
        return
    order = np.lexsort((two, one))
    one, two, owner, at, many = one[order], two[order], owner[order], at[order], many[order]
    new = np.concatenate([[True], (np.diff(one) != 0) | (np.diff(two) != 0)])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(one)))
    tell = np.repeat(size > 1, size) & ~many
    yield from _settled(owner[tell], at[tell], ranges)
    # One entry a distinct window; it needs an address only if it stood once here.
    one, two, owner, at, many = one[first], two[first], owner[first], at[first], np.logical_or.reduceat(many, first) | (size > 1)
    group = (one % np.uint64(ranges)).astype(np.int64) // fan
    order = np.argsort(group, kind="stable")
    ids, blobs = [], []
    for g, a, b in _runs(group[order]):
        k = order[a:b]
        told, name = np.unique(owner[k], return_inverse=True)
        ids.append(g * fan + part)
        blobs.append(pack(one[k], two[k], np.packbits(many[k]), name.astype(np.uint32), at[k].astype(np.uint32), told))
    yield _message(ids, [None] * len(ids), blobs)


def _read_windows(blob: bytes) -> tuple[np.ndarray, ...]:
    one, two, many, name, at, told = unpack(blob, np.uint64, np.uint64, np.uint8, np.uint32, np.uint32, np.int64)
    return one, two, told[name], at.astype(np.int64), np.unpackbits(many, count=len(one)).astype(bool)


def _merge_windows(ranges: int, fan: int):
    """Work of one merger of exact windows: as if the chunks that sent them were one."""

    def work(merger: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        got, held = [], 0
        for i, blob in enumerate(blobs):
            got.append(_read_windows(blob))
            held += len(got[-1][0])
            if held >= MERGED // 2 or i == len(blobs) - 1:
                yield from _window_chunk(ranges, 1, 0, got)
                got, held = [], 0

    return work


def _windows(width: int, ranges: int, fan: int):
    """texts with hit blocks -> messages: the exact windows over each hit."""
    size = (width + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = []
        held = chunk = 0
        for batch in batches:
            texts = _text_array(batch.column(batch.schema.get_field_index("r_zip")).to_pylist())
            lists = batch.column(batch.schema.get_field_index("r_starts")).to_pylist()
            names = batch.column(batch.schema.get_field_index("r_row")).to_pylist()
            for a, b in text_slices(texts):
                w = split_words(texts.slice(a, b - a))
                take, owner = [], []
                for i in range(a, b):
                    s = np.array(lists[i], np.int64)
                    # Each window holds one whole block, so the windows over different blocks are different.
                    at = (s[:, None] - np.arange(size)).ravel()
                    at = at[(at >= 0) & (at <= w.ends[i - a + 1] - w.ends[i - a] - width)]
                    take.append(at + w.ends[i - a])
                    owner.append(np.full(len(at), names[i], np.int64))
                at, own = np.concatenate(take), np.concatenate(owner)
                one = _hasher(2).windows(_hasher(2).words(w), width)[at]
                two = _hasher(3).windows(_hasher(3).words(w), width)[at]
                found.append((one, two, own, at - w.ends[np.searchsorted(w.ends, at, side="right") - 1], np.zeros(len(at), bool)))
                held += len(at)
                if held >= CHUNK // 2:
                    yield from _window_chunk(ranges, fan, _part(chunk, fan), found)
                    found, held, chunk = [], 0, chunk + 1
        if held:
            yield from _window_chunk(ranges, fan, _part(chunk, fan), found)

    return run


def _match_windows(rng: int, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One hash range of exact windows: tell the texts whose windows stand elsewhere too."""
    got = [_read_windows(blob) for blob in blobs]
    one, two, owner, at, many = (np.concatenate([g[i] for g in got]) for i in range(5))
    order = np.lexsort((two, one))
    one, two, many, owner, at = one[order], two[order], many[order], owner[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(one) != 0) | (np.diff(two) != 0)]))
    size = np.diff(np.append(first, len(one)))
    tell = np.repeat(size > 1, size) & ~many  # what stood twice in its chunk has been told there
    return owner[tell], at[tell]


def _finish(width: int, digest: bool):
    """texts and the starts of their repeated windows -> kept words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _text_array(batch.column(batch.schema.get_field_index("r_zip")).to_pylist())
            lists = batch.column(batch.schema.get_field_index("r_vals")).to_pylist()
            shas = batch.column(batch.schema.get_field_index("r_sha")).to_pylist()
            for a, b in text_slices(texts):
                w = split_words(texts.slice(a, b - a))
                at = [np.array(lists[i], np.int64) + w.ends[i - a] for i in range(a, b) if lists[i]]
                step = np.zeros(len(w.start) + 1, np.int64)
                if at:
                    starts = np.concatenate(at)
                    np.add.at(step, starts, 1)
                    np.add.at(step, starts + width, -1)
                keep = np.cumsum(step)[:-1] == 0
                gone = np.concatenate([[0], np.cumsum(~keep)])[w.ends]
                kept = _kept(w, keep)
                if digest:
                    last = {"r_out": pa.array([shas[a + i] or hashlib.sha256(k).hexdigest() for i, k in enumerate(kept)])}
                else:
                    own = texts.slice(a, b - a).to_pylist()
                    last = {"r_out": pa.array([k.decode() if n else t for k, n, t in zip(kept, np.diff(gone).tolist(), own, strict=True)], pa.string())}
                yield _with(batch.slice(a, b - a), ("r_zip", "r_vals", "r_sha", "r_row", "r_starts", "r_key"), r_removed=pa.array(np.diff(gone), pa.int64()), **last)

    return run


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = text_column(batch, "r_text").cast(pa.binary())
        yield _with(batch, ("r_text",), r_zip=pa.array([packer.compress(x) for x in texts.to_pylist()], pa.binary()))


def _schema(df: DataFrame, drop: tuple[str, ...], *more: tuple[str, str]) -> StructType:
    out = StructType([f for f in df.schema.fields if f.name not in drop])
    for name, kind in more:
        out = out.add(name, DataType.fromDDL(kind))
    return out


def _answered(messages: DataFrame, merge, match, ranges: int) -> DataFrame:
    """Send messages to their hash ranges, by way of their groups if a chunk dealt to groups, and what those find to where each text's findings meet."""

    def dealt(df: DataFrame, to: str, ids: int) -> DataFrame:
        places = min(ids, PLACES)
        df = df.repartitionById(places, F.col(to) % places)
        return df.sortWithinPartitions(to) if places < ids else df

    fan = _fan(ranges)
    if fan > 1:
        mergers = -(-ranges // fan) * fan
        messages = dealt(messages, "r_range", mergers).mapInArrow(released(_by_range(merge(ranges, fan))), _MESSAGE)
    found = dealt(messages, "r_range", ranges).mapInArrow(released(_by_range(_matched(match, ranges))), _MESSAGE)
    return dealt(found, "r_dest", ranges).mapInArrow(released(_gather), _FOUND)


def remove_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH, digest: bool = False) -> DataFrame:
    """All other columns of ``docs`` with n_words, n_removed and what is kept: as ``text``, or hashed as kept_sha256.

    A text that loses words is its kept words joined by one space, and so is what is hashed; as ``text``, one that loses
    none stays as it is (null becomes empty).
    """
    spark = docs.sparkSession
    rest = [f for f in docs.schema.fields if f.name not in (text, "n_words", "n_removed", "kept_sha256")]
    hashed = [F.col(f"`{f.name}`").cast("string") for f in rest if isinstance(f.dataType, AtomicType)]
    rows = docs.select(
        F.struct(*[F.col(f"`{f.name}`") for f in rest]).alias("r_rest") if rest else F.struct(F.lit(0).alias("none")).alias("r_rest"),
        F.col(f"`{text}`").alias("r_text"),
        F.xxhash64(F.col(f"`{text}`"), *hashed).alias("r_key"),  # rows that share a key share a text; a clash only adds candidates
    )
    total = rows.agg(F.sum(F.octet_length("r_text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))

    told = rows.select("r_key", "r_text").mapInArrow(released(_probes(width, ranges, _fan(ranges))), _MESSAGE)
    hits = _answered(told, _merge_blocks, _match_blocks, ranges)  # at most a text's blocks a row
    zipped = rows.mapInArrow(released(_zipped), _schema(rows, ("r_text",), ("r_zip", "binary")))
    both = zipped.join(hits, "r_key", "left").select("r_rest", "r_zip", "r_vals")
    step = both.mapInArrow(
        released(_hit_blocks(width, ranges, digest)),
        _schema(both, ("r_zip", "r_vals"), ("r_words", "long"), ("r_starts", "array<int>"), ("r_zip", "binary"), ("r_sha", "string")),
    )
    step = stored(step.withColumn("r_row", F.monotonically_increasing_id()), "repeats")

    hit = step.filter("r_starts IS NOT NULL").select("r_row", "r_zip", "r_starts")
    windows = hit.agg(F.sum(F.size("r_starts"))).first()[0] or 0
    ranges2 = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-windows * width // (2 * CHUNK)))
    told = hit.mapInArrow(released(_windows(width, ranges2, _fan(ranges2))), _MESSAGE)
    spans = _answered(told, _merge_windows, _match_windows, ranges2).withColumnRenamed("r_key", "r_row")
    both = step.join(spans, "r_row", "left").select("r_rest", "r_words", "r_zip", "r_sha", "r_vals")
    done = both.mapInArrow(released(_finish(width, digest)), _schema(both, ("r_zip", "r_vals", "r_sha"), ("r_removed", "long"), ("r_out", "string")))
    return done.select(
        *[F.col(f"r_rest.`{f.name}`") for f in rest],
        F.col("r_words").alias("n_words"),
        F.col("r_removed").alias("n_removed"),
        F.col("r_out").alias("kept_sha256" if digest else text),
    )


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: words, removed words and the digest of the kept ones."""
    return remove_repeats(open_table(spark, sf_dir, "documents", "doc_id", "text"), digest=True)
