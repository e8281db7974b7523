from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tidemill.llm import bpe as B
from tidemill.llm.lexicon import Lexicon, _minimal, compile_lexicon

ALPHABET = "abcABCéÉßİΣς'sTt019#<|>endoftext \t\n\x0b\x0c\x1c\x85\xa0　́̈漢字あ가😀_-!?.,\x00\x7fKǅ"


@pytest.fixture(scope="module")
def vocabulary():
    return B.vocabulary_text()


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_str(vocabulary)


def test_codec_equals_the_library(vocabulary, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", "<|endoftext|>a<|startoftext|>b <|endoftext|>", "x" * 5000, "thequickbrownfox" * 100, " \x0b \x0c x", "we'LL 'S it'sx"]
    merger = B.Merger(vocabulary)
    words = sorted({w.encode() for w in ("the", "wher.", "abc", "a", "b.", "é", "'s")})
    codec = B.Codec(vocabulary, compile_lexicon(words, [merger.word(w.decode()) for w in words]))
    ids, ends = codec.encode(pa.array(texts))
    for i, (text, back) in enumerate(zip(texts, codec.decode(ids, ends))):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[ends[i] : ends[i + 1]].tolist() == want, repr(text)
        assert back.decode() == library.decode(want, skip_special_tokens=False)


def test_long_pieces_merge_like_short_ones(vocabulary):
    merger = B.Merger(vocabulary)
    rng = random.Random(2)
    for _ in range(200):
        piece = "".join(rng.choice("thenigadr") for _ in range(rng.randint(2, 48)))
        parts = [*piece[:-1], piece[-1] + B.END]
        assert merger._merge_long(parts) == merger.merge(piece)


def test_transducer_is_minimal_and_exact():
    rng = random.Random(3)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 6))) for _ in range(300)})
    ids = [[i, i + 1] for i in range(len(words))]
    lexicon = Lexicon(compile_lexicon(words, ids))
    probes = words + [w + b"c" for w in words] + [b"zzz", b"abcabcabc"]
    data = np.frombuffer(b"".join(probes), np.uint8)
    ends = np.cumsum([0] + [len(p) for p in probes])
    rows = lexicon.rows(data, ends[:-1], ends[1:])
    place = {w: i for i, w in enumerate(words)}
    assert rows.tolist() == [place.get(p, -1) for p in probes]
    # Minimal: no two states accept the same endings.
    seen, states = set(), set()

    def endings(state):
        states.add(id(state))
        out = frozenset({b""} if state.final else set()) | {bytes([c]) + e for c, s in state.arcs.items() for e in endings(s)}
        seen.add(out)
        return out

    endings(_minimal(words))
    assert len(seen) == len(states)


def test_query_equals_the_library(spark, library):
    docs = brute.table("documents")
    rows = {r["doc_id"]: r for r in B.op2_bpe(spark, brute.SMALL).collect()}
    assert len(rows) == len(docs)
    for i, text in zip(docs.doc_id, docs.text):
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        assert want == (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"])


def test_edges(spark, edge, empty, library):
    out = B.encode(edge)
    assert out.columns == [c for c in edge.columns if c != "ids"] + ["ids"]
    for r in out.collect():
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert B.encode(empty).count() == 0 and B.digests(empty).count() == 0


def test_lexicon_bound(spark, edge):
    assert B.frequent_words(edge, most=0) == []
    few = B.frequent_words(edge, most=50)
    assert len(few) <= 50
