"""Operator 13. SentencePiece encoding and decoding that keeps every piece's place in the original bytes.

A text is normalised by the longest prefix that the model's compiled
character map knows at each place (a double-array trie read straight from
the model file); every normalised byte remembers the original byte it comes
from. The normalised text is then merged pair by pair, best score first and
leftmost on ties, and each piece is projected back through that record to a
span of original UTF-8 bytes: ``begins[i]`` to ``ends[i]`` for ``ids[i]``.

Where no piece of the model holds a word mark behind another character (true
of every model trained with words split at white space) merges cannot cross
the start of a word: a text is cut there, and the distinct words of a batch
are merged together, one merge a word and round over arrays. Long words,
words with unknown characters and other models are merged one at a time.

Defined cases: null texts are empty texts; an empty text has only the begin
and end ids (empty spans at 0) and decodes to the empty text; a character the
model lacks becomes its bytes where the model has byte pieces (all but the
last byte with an empty span), else the unknown id, of which neighbours fold
into one; repeated rows give equal rows; other columns of the input, also
ones named like the results, are not read. Texts of any length are encoded
whole, n log n in the longest word.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidemill.llm.common import kept, open_table, released, text_column, text_slices

MARK = "▁"
#: Merged words a Python worker remembers: distinct words, and their ids in all.
CACHE_WORDS, CACHE_IDS = 200_000, 2_000_000
#: Words of up to so many characters are merged together, by these steps of length.
BOUNDS = (8, 16, 32)


def model_bytes(path: str | None = None) -> bytes:
    """The model file; by default the public 32k piece vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


class CharMap:
    """Longest-prefix replacement by a compiled character map: trie units, then the replacements, zero-ended."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes read, replacement) of the longest known prefix of ``data`` from ``at``."""
        units, found = self.units, None
        node = self._child(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(0, found[1])]


class Normaliser:
    """A normaliser of the model file: text in, normalised bytes and their origins out."""

    def __init__(self, spec, suffix: bool = False, whole: list[str] = ()):
        self.map = CharMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.dummy, self.squeeze, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, suffix
        self.space = MARK.encode() if spec.escape_whitespaces else b" "
        ordered = sorted((w.encode() for w in whole), key=len, reverse=True)
        self.whole = re.compile(b"|".join(map(re.escape, ordered))) if ordered else None
        #: Nothing is replaced or dropped but spaces: one vectorised pass.
        self.plain = self.map is None and self.whole is None and not self.squeeze and not suffix

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        if self.whole is not None and (m := self.whole.match(data, at)):
            return m.end() - at, m.group()
        if self.map is not None and (hit := self.map.longest(data, at)):
            return hit
        first = data[at]
        n = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return n, data[at : at + n]

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) the original byte it starts from."""
        if not data:
            return b"", np.zeros(1, np.int64)
        return self._plain(data) if self.plain else self._mapped(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        head = self.space if self.dummy else b""
        width = np.ones(len(data) + 1, np.int64)
        width[:-1][np.frombuffer(data, np.uint8) == 0x20] = len(self.space)
        origin = np.repeat(np.arange(len(data) + 1), width)
        return head + data.replace(b" ", self.space), np.concatenate([np.zeros(len(head), np.int64), origin])

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, origin, at = bytearray(), array("q"), 0
        if self.squeeze:
            while at < len(data):
                n, text = self._prefix(data, at)
                if text != b" ":
                    break
                at += n
            if at == len(data):
                return b"", np.zeros(1, np.int64)

        def put(text: bytes) -> None:
            out.extend(text)
            origin.extend([at] * len(text))

        if self.dummy and not self.suffix:
            put(self.space)
        after_space = self.squeeze
        while at < len(data):
            n, text = self._prefix(data, at)
            if after_space:
                text = text.lstrip(b" ")
            if text:
                put(text.replace(b" ", self.space))
                after_space = text.endswith(b" ")
            at += n
            if not self.squeeze:
                after_space = False
        if self.squeeze:
            while out.endswith(self.space):
                at = origin[len(out) - len(self.space)]
                del out[-len(self.space) :]
                del origin[-len(self.space) :]
        if self.dummy and self.suffix:
            put(self.space)
        origin.append(at)
        return bytes(out), np.frombuffer(origin, np.int64)


class Pairs:
    """All pairs of pieces that make a piece, as an open hash table over arrays: (left, right) to rank << 32 | id."""

    NONE = np.int64((1 << 62) - 1)

    def __init__(self, ids: dict[str, int], ranks: dict[str, int]):
        found = [
            (ids[a], ids[b], ranks[whole] << 32 | i)
            for whole, i in ids.items()
            for at in range(1, len(whole))
            if (a := whole[:at]) in ids and (b := whole[at:]) in ids
        ]
        pairs = np.array(found, np.int64).reshape(-1, 3)
        self.bits = max(10, (8 * len(pairs)).bit_length())
        keys, values = pairs[:, 0] << 32 | pairs[:, 1], pairs[:, 2]
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, self.NONE)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # each free slot takes one of the keys that ask for it, the others go on to the next
            _, first = np.unique(slot[left], return_index=True)
            first = left[first]
            first = first[self.keys[slot[first]] == -1]
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            left = np.setdiff1d(left, first, assume_unique=True)
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 32 | id of each pair; NONE where it makes no piece or a side is negative."""
        keys = left.astype(np.int64) << 32 | right
        out = np.full(keys.shape, self.NONE)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        flat, keys = out.reshape(-1), keys.reshape(-1)[todo]
        slot = self._slot(keys)
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            flat[todo[hit]] = self.values[slot[hit]]
            on = np.flatnonzero(~hit & (there != -1))
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


class Codec:
    """Encoder and decoder of batches of texts for one model file."""

    def __init__(self, raw: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(raw)
        kind, trainer = proto.ModelProto.SentencePiece, model.trainer_spec
        if trainer.model_type != proto.TrainerSpec.BPE:
            raise ValueError("not a BPE model")
        self.names = [p.piece for p in model.pieces]
        self.types = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (kind.NORMAL, kind.USER_DEFINED, kind.UNUSED)}
        order = {score: i for i, score in enumerate(sorted({p.score for p in model.pieces}, reverse=True))}
        self.ranks = {p.piece: order[p.score] for p in model.pieces if p.piece in self.ids}
        self.pairs = Pairs(self.ids, self.ranks)
        self.letters = np.full(0x110000, -1, np.int32)
        for name, i in self.ids.items():
            if len(name) == 1:
                self.letters[ord(name)] = i
        self.unused = {p.piece for p in model.pieces if p.type == kind.UNUSED}
        whole = [p.piece for p in model.pieces if p.type == kind.USER_DEFINED]
        self.whole = re.compile("|".join(map(re.escape, sorted(whole, key=len, reverse=True)))) if whole else None
        self.unknown = self.types.index(kind.UNKNOWN)
        self.bytes_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_ids = {b: i for i, b in self.bytes_of.items()} if trainer.byte_fallback else {}
        self.control = {i for i, t in enumerate(self.types) if t == kind.CONTROL}
        self.is_control = np.array([t == kind.CONTROL for t in self.types])
        named = {p.piece: i for i, p in enumerate(model.pieces)}
        self.bos, self.eos = named[trainer.bos_piece], named[trainer.eos_piece]
        self.surface = trainer.unk_surface
        spec = model.normalizer_spec
        self.normal = Normaliser(spec, trainer.treat_whitespace_as_suffix, whole)
        self.back = Normaliser(model.denormalizer_spec) if model.denormalizer_spec.precompiled_charsmap else None
        if self.back is not None:
            self.back.dummy = self.back.squeeze = False
            self.back.space, self.back.plain = b" ", False
        self.strip, self.strip_all = spec.add_dummy_prefix or spec.remove_extra_whitespaces, spec.remove_extra_whitespaces
        inside = any(re.search(f"[^{MARK}]{MARK}", n) for n in self.ids)
        self.words = None if inside or whole or not self.byte_ids else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        texts = [b"" if i in self.control else bytes([self.bytes_of[i]]) if i in self.bytes_of else (self.surface if i == self.unknown else n.replace(MARK, " ")).encode() for i, n in enumerate(self.names)]
        self.text_ends = np.cumsum([0] + [len(t) for t in texts])
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self._clear()

    @classmethod
    def of(cls, raw: bytes) -> Codec:
        key = hashlib.md5(raw).hexdigest()
        made = kept(__name__)
        if key not in made:
            made.clear()
            made[key] = cls(raw)
        return made[key]

    # Merging.

    def _clear(self) -> None:
        self.seen: dict[str, int] = {}
        self.flat, self.begin, self.end = array("i"), array("i"), array("i")
        self.starts, self.sizes = array("q", [0]), array("q")

    def pieces(self, text: str) -> list[str]:
        """Pieces of a normalised text: the neighbours of the best score first, leftmost on ties.

        A heap and a linked list, n log n; symbols kept whole and unused pieces, which fall apart again, too.
        """
        if self.whole is None:
            parts, frozen = list(text), None
        else:
            parts, frozen, at = [], [], 0
            while at < len(text):
                m = self.whole.match(text, at)
                parts.append(m.group() if m else text[at])
                frozen.append(bool(m))
                at += len(parts[-1])
        n, ranks = len(parts), self.ranks
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        halves: dict[str, tuple[str, str]] = {}

        def pair(i: int, j: int):
            if frozen is not None and (frozen[i] or frozen[j]):
                return None
            both = parts[i] + parts[j]
            rank = ranks.get(both)
            if rank is None:
                return None
            if both in self.unused:
                halves[both] = (parts[i], parts[j])
            return (rank, i, j, both)

        heap = [p for i in range(n - 1) if (p := pair(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not parts[i] or not parts[j] or after[i] != j or len(parts[i]) + len(parts[j]) != len(both):
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (p := pair(x, y)) is not None:
                    heapq.heappush(heap, p)
        if not halves:
            return [p for p in parts if p]

        def split(piece: str) -> Iterator[str]:
            if piece in self.unused and piece in halves:
                for half in halves[piece]:
                    yield from split(half)
            else:
                yield piece

        return [q for p in parts if p for q in split(p)]

    def _merged(self, text: str) -> tuple[list[int], list[int], list[int], int]:
        """Ids, begins and ends (in normalised bytes) of a normalised text, and its size."""
        ids, begins, ends, at = [], [], [], 0
        for piece in self.pieces(text):
            one = self.ids.get(piece, self.unknown)
            if one != self.unknown:
                to = at + (len(piece) if piece.isascii() else len(piece.encode()))
                ids.append(one)
                begins.append(at)
                ends.append(to)
                at = to
                continue
            raw = piece.encode()
            to = at + len(raw)
            if self.byte_ids:
                ids += [self.byte_ids[b] for b in raw]
                begins += [at] * len(raw)
                ends += [at] * (len(raw) - 1) + [to]
            elif ids and ids[-1] == one:
                ends[-1] = to
            else:
                ids.append(one)
                begins.append(at)
                ends.append(to)
            at = to
        return ids, begins, ends, at

    def _add(self, word: str) -> None:
        ids, begins, ends, size = self._merged(word)
        self.flat.extend(ids)
        self.begin.extend(begins)
        self.end.extend(ends)
        self.starts.append(len(self.flat))
        self.sizes.append(size)
        self.seen[word] = len(self.sizes) - 1

    def learn(self, words: list[str]) -> None:
        """Merge words not seen before: those of known letters together, by length, the others one by one."""
        if self.words is None or self.unused:
            for word in words:
                self._add(word)
            return
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        first = np.cumsum(lengths) - lengths
        letters = self.letters[points]
        odd = np.add.reduceat(letters < 0, first) > 0 if len(words) else np.empty(0, bool)
        alone = odd | (lengths > BOUNDS[-1])
        for i in np.flatnonzero(alone):
            self._add(words[i])
        bytes_of = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        for low, high in zip((0, *BOUNDS), BOUNDS, strict=False):
            some = np.flatnonzero(~alone & (lengths > low) & (lengths <= high))
            for part in np.array_split(some, len(some) // 20_000 + 1):
                if len(part):
                    self._add_together([words[i] for i in part], letters, bytes_of, first[part], lengths[part], high)

    def _add_together(self, words, letters, bytes_of, first, lengths, width: int) -> None:
        column = np.arange(width)
        inside = column < lengths[:, None]
        spot = np.where(inside, first[:, None] + column, 0)
        symbols = np.where(inside, letters[spot], -1)
        upto = np.cumsum(np.where(inside, bytes_of[spot], 0), axis=1)
        begins = np.concatenate([np.zeros((len(words), 1), np.int64), upto[:, :-1]], axis=1)  # byte where a symbol starts
        sizes = upto[:, -1]
        symbols, begins = self._rounds(symbols, begins)
        stays = symbols >= 0
        count = stays.sum(axis=1)
        flat, begin = symbols[stays], begins[stays]
        end = np.empty_like(begin)
        end[:-1] = begin[1:]
        end[np.cumsum(count) - 1] = sizes
        base, known = len(self.flat), len(self.sizes)
        for to, values in ((self.flat, flat), (self.begin, begin), (self.end, end)):
            to.frombytes(values.astype(np.int32).tobytes())
        self.starts.frombytes((base + np.cumsum(count)).astype(np.int64).tobytes())
        self.sizes.frombytes(sizes.astype(np.int64).tobytes())
        self.seen.update(zip(words, range(known, known + len(words)), strict=True))

    def _rounds(self, symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of symbols (-1 past their end), each its best pair a round, until no row has one."""
        out, out_begins = np.full_like(symbols, -1), np.zeros_like(begins)
        rows, column = np.arange(len(symbols)), np.arange(symbols.shape[1])
        pad = lambda m, fill: np.concatenate([m, np.full((len(m), 1), fill, m.dtype)], axis=1)
        value = pad(self.pairs.look(symbols[:, :-1], symbols[:, 1:]), self.pairs.NONE)  # of each symbol with the next
        while len(rows):
            at = (value >> 32).argmin(axis=1)
            best = value[np.arange(len(rows)), at]
            on = best != self.pairs.NONE
            out[rows[~on]], out_begins[rows[~on]] = symbols[~on], begins[~on]
            rows, at, best, symbols, begins, value = rows[on], at[on], best[on], symbols[on], begins[on], value[on]
            if not len(rows):
                break
            each = np.arange(len(rows))
            symbols[each, at] = best & 0xFFFFFFFF
            # The right half goes: what stands behind it moves one to the left.
            moved = column + (column > at[:, None])
            symbols = np.take_along_axis(pad(symbols, -1), moved, 1)
            begins = np.take_along_axis(pad(begins, 0), moved, 1)
            moved = column + (column >= at[:, None])
            value = np.take_along_axis(pad(value, self.pairs.NONE), moved, 1)
            after = np.minimum(at + 1, len(column) - 1)
            value[each, at] = np.where(at < after, self.pairs.look(symbols[each, at], symbols[each, after]), self.pairs.NONE)
            inner = np.flatnonzero(at > 0)
            before = at[inner] - 1
            value[inner, before] = self.pairs.look(symbols[inner, before], symbols[inner, at[inner]])
        return out, out_begins

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends, offsets): text i has the entries offsets[i]:offsets[i + 1]; begin and end ids included."""
        if len(self.seen) > CACHE_WORDS or len(self.flat) > CACHE_IDS:
            self._clear()
        seen = self.seen
        found, origins, counts, sizes = [], [], [], []
        for text in texts:
            normal, origin = self.normal(text.encode())
            words = self.words.findall(normal.decode()) if self.words else [normal.decode()] if normal else []
            found += words
            origins.append(origin)
            counts.append(len(words))
            sizes.append(len(normal))
        self.learn([w for w in dict.fromkeys(found) if w not in seen])
        code = np.fromiter(map(seen.__getitem__, found), np.int64, len(found))
        table = [np.array(a) for a in (self.flat, self.begin, self.end, self.starts, self.sizes)]
        flat, begin, end, starts, lengths = table
        per = np.diff(starts)[code] if len(code) else np.empty(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
        row = np.repeat(starts[:-1][code] - upto[:-1], per) + np.arange(upto[-1]) if len(code) else np.empty(0, np.int64)
        # Place of each word in the origins of all texts, which hold one entry more than a text has bytes.
        text_of = np.repeat(np.arange(len(texts)), counts)
        place = np.concatenate([[0], np.cumsum(lengths[code])])[:-1] + text_of if len(code) else np.empty(0, np.int64)
        origin = np.concatenate(origins) if origins else np.zeros(1, np.int64)
        at = np.repeat(place, per)
        words_upto = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        inner = upto[words_upto]  # entries before each text, begin and end ids left out
        offsets = inner + 2 * np.arange(len(texts) + 1)
        ids, begins, ends = (np.zeros(offsets[-1], np.int64) for _ in range(3))
        spot = np.arange(upto[-1]) + 2 * np.repeat(text_of, per) + 1
        ids[spot], begins[spot], ends[spot] = flat[row], origin[at + begin[row]], origin[at + end[row]]
        ids[offsets[:-1]], ids[offsets[1:] - 1] = self.bos, self.eos
        last = origin[np.cumsum(np.array(sizes, np.int64) + 1) - 1] if len(texts) else np.empty(0, np.int64)
        begins[offsets[1:] - 1] = ends[offsets[1:] - 1] = last
        return ids, begins, ends, offsets

    # Decoding.

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """UTF-8 of each list of ids."""
        size = np.diff(self.text_ends)[ids]
        at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        data = self.text_bytes[np.repeat(self.text_ends[ids] - at[:-1], size) + np.arange(at[-1])].tobytes()
        for a, b in zip(offsets, offsets[1:], strict=False):
            text = data[at[a] : at[b]]
            # Silent ids inside a text may stand between bytes that form no character together.
            if self.strip_all or self.back is not None or self.is_control[ids[a + 1 : b - 1]].any():
                yield self._decode_one(ids[a:b].tolist())
                continue
            try:
                text.decode()
            except UnicodeDecodeError:  # bytes that are no characters
                yield self._decode_one(ids[a:b].tolist())
                continue
            first = next((int(i) for i in ids[a:b] if int(i) not in self.control), None)
            strip = self.strip and first is not None and self.names[first].startswith(MARK)
            yield text[1:] if strip else text

    def _decode_one(self, ids: list[int]) -> bytes:
        out, run, opening, dropped = [], bytearray(), True, False

        def flush() -> None:
            at = 0
            while at < len(run):
                n = next((k for k in (1, 2, 3, 4) if _is_char(run[at : at + k])), 0)
                out.append(bytes(run[at : at + n]) if n else "�".encode())
                at += n or 1
            run.clear()

        for i in ids:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            flush()
            if dropped or any(out):
                opening = False
            name, dropped = self.names[i], False
            if i in self.control:
                text = ""
            elif i == self.unknown:
                text = self.surface
            else:
                if opening and self.strip and name.startswith(MARK):
                    name, dropped = name[1:], not self.strip_all
                text = name.replace(MARK, " ")
            out.append(text.encode())
        flush()
        text = b"".join(out)
        return self.back(text)[0] if self.back is not None else text


def _is_char(data: bytearray) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def _codec(spark: SparkSession, model_path: str | None):
    shared = spark.sparkContext.broadcast(model_bytes(model_path))  # bounded by the model file
    return lambda: Codec.of(shared.value)


def encode(docs: DataFrame, text: str = "text", model_path: str | None = None) -> DataFrame:
    """All columns of ``docs``, ``ids`` and the original byte spans ``begins``, ``ends`` (arrays of int).

    Columns of these names are replaced.
    """
    codec, added = _codec(docs.sparkSession, model_path), ("ids", "begins", "ends")
    rest = docs.drop(*[c for c in added if c != text])
    schema = StructType([*(f for f in rest.schema.fields if f.name not in added), *(StructField(c, ArrayType(IntegerType())) for c in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            texts = text_column(batch, text)
            keep = [i for i, n in enumerate(batch.schema.names) if n not in added]
            for a, b in text_slices(texts, 1 << 20):
                *found, offsets = own.encode(texts.slice(a, b - a).to_pylist())
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in found]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), *lists], names=schema.names)

    return rest.mapInArrow(released(run), schema)


def decode(rows: DataFrame, ids: str = "ids", out: str = "decoded", model_path: str | None = None) -> DataFrame:
    """All columns of ``rows`` and ``out``, the text of the ids; null ids decode to the empty text."""
    codec = _codec(rows.sparkSession, model_path)

    @F.pandas_udf("string")
    def text_of(lists):
        own = codec()
        found = [np.asarray(x if x is not None else [], np.int64) for x in lists]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        flat = np.concatenate([np.empty(0, np.int64), *found])
        import pandas as pd

        return pd.Series([t.decode() for t in own.decode(flat, offsets)], index=lists.index, dtype=object)

    return rows.withColumn(out, text_of(F.col(ids)))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model_path: str | None = None) -> DataFrame:
    """id, n_tokens, hashes of the ids (32-bit little-endian) and of what they decode to, and of the spans.

    ``spans_sha256`` hashes the begins, then the ends, as 64-bit little-endian integers.
    """
    codec = _codec(docs.sparkSession, model_path)
    rows = docs.select(F.col(doc_id).alias("p_id"), F.col(text).alias("p_text"))
    kind = rows.schema["p_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            texts = text_column(batch, "p_text")
            for a, b in text_slices(texts, 1 << 20):
                ids, begins, ends, offsets = own.encode(texts.slice(a, b - a).to_pylist())
                raw, cuts = ids.astype("<u4"), list(zip(offsets, offsets[1:], strict=False))
                one = [hashlib.sha256(raw[x:y].tobytes()).hexdigest() for x, y in cuts]
                two = [hashlib.sha256(t).hexdigest() for t in own.decode(ids, offsets)]
                three = [hashlib.sha256(begins[x:y].tobytes() + ends[x:y].tobytes()).hexdigest() for x, y in cuts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets), pa.int64()), pa.array(one), pa.array(two), pa.array(three)],
                    names=["p_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"],
                )

    return rows.mapInArrow(released(run), f"p_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document, encoded with begin and end ids, and decoded."""
    return digests(open_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("p_id", "doc_id")
