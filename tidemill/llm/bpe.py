"""Operator 2. BPE encoding and decoding through a lexicon of frequent words.

The words (runs without white space) of all documents are counted; the
frequent ones are encoded once and compiled into a minimal acyclic transducer
whose outputs lead to their token ids (``lexicon.py``). A batch of texts is
cut into words, the distinct words are looked up together, and a word the
lexicon lacks is merged exactly, pair by pair in rank order. Decoding joins
the tokens' strings with a space, as the vocabulary's file asks (no decoder).

White space separates the pieces of this vocabulary's pre-tokenizer and is
dropped, so a text's ids are its words' ids in order.

Defined cases: null and empty texts have no tokens and decode to the empty
text; special tokens written in a text get their own ids, as the file asks;
words longer than ``LONGEST`` bytes are never in the lexicon and always
merged; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidemill.llm.common import hand_back, kept, open_table, released, text_column, text_slices, words_of
from tidemill.llm.lexicon import Lexicon, compile_lexicon

#: Bounds of the lexicon, and so of what is broadcast: words and bytes a word.
WORDS, LONGEST = 1 << 18, 48
CACHE = 100_000  # merged pieces remembered by a Python worker

_SIMPLE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
END = "</w>"


def vocabulary_text(path: str | None = None) -> str:
    """The tokenizer file; by default the public 49k word vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


class Merger:
    """Exact encoding of one word at a time, for words the lexicon lacks."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {p: i for i, p in reversed(list(enumerate(pairs)))}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        own = Tokenizer.from_str(vocabulary)
        self.normal, self.pieces_of = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.seen: dict[str, list[int]] = {}
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]

    def merge(self, piece: str) -> list[int]:
        """Token ids of one pre-token (in the byte alphabet): the lowest-ranked pair, leftmost first, again and again."""
        parts = [*piece[:-1], piece[-1] + END]
        parts = [p for p in parts if p in self.vocab]  # no unknown token in this vocabulary
        if len(parts) > 48:
            return self._merge_long(parts)
        ranks, none = self.ranks, len(self.ranks)
        while len(parts) > 1:
            found = [ranks.get(p, none) for p in zip(parts, parts[1:], strict=False)]
            best = min(found)
            if best == none:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.vocab[p] for p in parts]

    def _merge_long(self, parts: list[str]) -> list[int]:
        """The same with a heap and a linked list, n log n for a very long piece."""
        n = len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [self.vocab[p] for p in parts if p]

    def piece(self, piece: str) -> list[int]:
        ids = self.seen.get(piece)
        if ids is None:
            ids = self.merge(piece)
            if len(piece) <= LONGEST:
                if len(self.seen) >= CACHE:
                    self.seen.clear()
                self.seen[piece] = ids
        return ids

    def word(self, word: str) -> list[int]:
        """Token ids of a run without white space."""
        if self.split is not None and "<" in word and self.split.search(word):
            out: list[int] = []
            for part in self.split.split(word):
                out += [self.special[part]] if part in self.special else self.word(part) if part else []
            return out
        if word.isascii() and word.isprintable():
            pieces = _SIMPLE.findall(word.lower())  # what the file's normaliser and pattern do to such a word
        else:
            pieces = [p for p, _ in self.pieces_of(self.normal(word))]
        return [i for p in pieces for i in self.piece(p)]


class Codec:
    """Encoder and decoder of batches of texts: lexicon first, exact merges for the rest."""

    def __init__(self, vocabulary: str, lexicon: bytes):
        self.merger, self.lexicon = Merger(vocabulary), Lexicon(lexicon)
        names = [(n + " ").encode() for n in self.merger.names]
        self.name_ends = np.cumsum([0] + [len(n) for n in names])
        self.name_bytes = np.frombuffer(b"".join(names), np.uint8)

    @classmethod
    def of(cls, key: str, vocabulary: str, lexicon: bytes) -> Codec:
        made = kept(__name__)
        if key not in made:
            made.clear()
            made[key] = cls(vocabulary, lexicon)
            hand_back()  # what reading the vocabulary took
        return made[key]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ends): text i has ids[ends[i]:ends[i + 1]]."""
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten().dictionary_encode()
        codes, words = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        rows = self.lexicon.rows(data, ends[:-1], ends[1:])
        missing = np.flatnonzero(rows < 0)
        merged = [self.merger.word(w) for w in words.take(pa.array(missing)).to_pylist()]
        # One table of ids by distinct word: the lexicon's rows where they are, the merged ones behind them.
        start, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        known = rows >= 0
        start[known], count[known] = self.lexicon.ends[rows[known]], np.diff(self.lexicon.ends)[rows[known]]
        sizes = np.array([len(x) for x in merged], np.int64)
        start[missing], count[missing] = len(self.lexicon.ids) + np.cumsum(sizes) - sizes, sizes
        table = np.concatenate([self.lexicon.ids, np.array([i for x in merged for i in x], np.int32)])
        per_word = count[codes]
        word_ends = np.concatenate([[0], np.cumsum(per_word)])
        ids = table[np.repeat(start[codes] - word_ends[:-1], per_word) + np.arange(word_ends[-1])]
        offsets = lists.offsets.to_numpy().astype(np.int64)
        return ids, word_ends[offsets - offsets[0]]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        """UTF-8 of each text's tokens, joined by a space."""
        size = np.diff(self.name_ends)[ids]
        at = np.concatenate([[0], np.cumsum(size)])
        data = self.name_bytes[np.repeat(self.name_ends[ids] - at[:-1], size) + np.arange(at[-1])].tobytes()
        for a, b in zip(ends, ends[1:], strict=False):
            yield data[at[a] : max(at[a], at[b] - 1)]


def frequent_words(docs: DataFrame, text: str = "text", most: int = WORDS) -> list[str]:
    """The words at or above the lowest count that no more than ``most`` words reach."""
    words = docs.select(F.explode(words_of(text)).alias("w")).filter(F.octet_length("w") <= LONGEST)
    counts = words.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").persist()
    # Counts below 1,024 as they are, larger ones by sixteenths of a power of two: a short histogram at any size.
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.ceil(F.pow(F.lit(2.0), F.floor(F.log2("n") * 16) / 16)))
    hist = sorted(((r["s"], r["k"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect()), reverse=True)
    floor, total = None, 0
    for s, k in hist:
        if total + k > most:
            break
        floor, total = s, total + k
    found = [] if floor is None else [r["w"] for r in counts.filter(F.col("n") >= floor).limit(most + 1).select("w").collect()]
    counts.unpersist()
    return found


def build_lexicon(docs: DataFrame, vocabulary: str, text: str = "text", most: int = WORDS) -> bytes:
    """Count the words of all texts and compile the frequent ones; at most ``most`` words of ``LONGEST`` bytes."""
    merger = Merger(vocabulary)
    words = sorted({w.encode("utf-8", "surrogatepass"): w for w in frequent_words(docs, text, most)}.items())
    return compile_lexicon([b for b, _ in words], [merger.word(w) for _, w in words])


def _codec(docs: DataFrame, text: str, vocabulary_path: str | None):
    vocabulary = vocabulary_text(vocabulary_path)
    lexicon = build_lexicon(docs, vocabulary, text)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, lexicon))  # bounded by the file and by WORDS * LONGEST
    key = hashlib.md5(vocabulary.encode() + lexicon).hexdigest()
    return lambda: Codec.of(key, *shared.value)


def encode(docs: DataFrame, text: str = "text", vocabulary_path: str | None = None) -> DataFrame:
    """All columns of ``docs`` and ``ids`` (array of int); a column of that name is replaced."""
    codec = _codec(docs, text, vocabulary_path)
    rest = docs.drop("ids")
    schema = StructType([*rest.schema.fields, StructField("ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            texts = text_column(batch, text)
            for a, b in text_slices(texts):
                ids, ends = own.encode(texts.slice(a, b - a))
                part = batch.slice(a, b - a)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "ids"])

    return rest.mapInArrow(released(run), schema)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary_path: str | None = None) -> DataFrame:
    """id, n_tokens, and the hashes of a text's ids (32-bit little-endian) and of what they decode to."""
    codec = _codec(docs, text, vocabulary_path)
    rows = docs.select(F.col(doc_id).alias("b_id"), F.col(text).alias("b_text"))
    kind = rows.schema["b_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            texts = text_column(batch, "b_text")
            for a, b in text_slices(texts):
                ids, ends = own.encode(texts.slice(a, b - a))
                raw = ids.astype("<u4")
                one = [hashlib.sha256(raw[x:y].tobytes()).hexdigest() for x, y in zip(ends, ends[1:], strict=False)]
                two = [hashlib.sha256(t).hexdigest() for t in own.decode(ids, ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(ends), pa.int64()), pa.array(one), pa.array(two)],
                    names=["b_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return rows.mapInArrow(released(run), f"b_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document, encoded and decoded."""
    return digests(open_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("b_id", "doc_id")
