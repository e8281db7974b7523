from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece as spm
from sentencepiece import sentencepiece_model_pb2 as proto

from tests.llm import brute
from tidemill.llm import pieces as P

ALPHABET = "abcABC ▁  \t\n\x00the éİ漢字あ가😀<s></s>unk>01_-!?ﬁＡ　\xa0́"


def texts(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["", " ", "   ", "▁", "x" * 5000, "a  b " * 100, "漢字" * 400, "thenation" * 30]


def compare(raw: bytes, some: list[str]) -> None:
    own, library = P.Codec(raw), spm.SentencePieceProcessor(model_proto=raw)
    ids, begins, ends, offsets = own.encode(some)
    for i, (text, back) in enumerate(zip(some, own.decode(ids, offsets), strict=True)):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids[offsets[i] : offsets[i + 1]].tolist() == want, repr(text)
        assert back.decode() == library.decode(want), repr(text)
        inner = slice(offsets[i] + 1, offsets[i + 1] - 1)
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(begins[inner].tolist(), ends[inner].tolist(), strict=True)) == spans, repr(text)


def model():
    m = proto.ModelProto()
    m.ParseFromString(P.model_bytes())
    return m


def test_codec_equals_the_library():
    compare(P.model_bytes(), texts(3000))


def test_spans_cover_the_text():
    own = P.Codec(P.model_bytes())
    some = [t for t in texts(500, 2) if t]
    _, begins, ends, offsets = own.encode(some)
    for i, text in enumerate(some):
        a, b = offsets[i] + 1, offsets[i + 1] - 1
        assert b"".join(text.encode()[x:y] for x, y in zip(begins[a:b], ends[a:b], strict=True)) == text.encode()


@pytest.mark.parametrize("change", ["unused", "whole", "no bytes", "mapped", "suffix"])
def test_other_models(change):
    """Unused pieces fall apart, user symbols stay whole, unknown characters fold, a character map and its spaces apply."""
    m = model()
    kind = proto.ModelProto.SentencePiece
    by_name = {p.piece: p for p in m.pieces}
    if change == "unused":
        for name in ("▁the", "th", "ab", "▁a"):
            if name in by_name:
                by_name[name].type = kind.UNUSED
    if change == "whole":
        for name in ("▁the", "he", "ab", "01"):
            if name in by_name:
                by_name[name].type = kind.USER_DEFINED
    if change == "no bytes":
        m.trainer_spec.byte_fallback = False
        for p in m.pieces:
            if p.type == kind.BYTE:
                p.type = kind.NORMAL
    if change == "mapped":
        rule = proto.ModelProto()
        rule.ParseFromString(spm.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
        m.normalizer_spec.CopyFrom(rule.normalizer_spec)
    if change == "suffix":
        m.trainer_spec.treat_whitespace_as_suffix = True
    compare(m.SerializeToString(), texts(400, 3))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_character_maps(rule):
    m = proto.ModelProto()
    m.ParseFromString(spm.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    spec = m.normalizer_spec
    for flags in [(0, 0, 0), (1, 0, 1), (1, 1, 1), (0, 1, 1), (1, 1, 0)]:
        spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = map(bool, flags)
        library, own = spm.SentencePieceNormalizer(model_proto=m.SerializeToString()), P.Normaliser(spec)
        for text in texts(300, 4)[:-4]:
            want, places = library.normalize(text, with_offsets=True)
            got, origin = own(text.encode())
            chars = np.cumsum([0] + [len(c.encode()) for c in text])
            starts = np.cumsum([0] + [len(c.encode()) for c in want])
            assert got.decode() == want and [int(chars[p]) for p in places] == [int(origin[s]) for s in starts], (flags, text)


def test_any_ids_decode_like_the_library():
    own, library = P.Codec(P.model_bytes()), spm.SentencePieceProcessor(model_proto=P.model_bytes())
    rng = random.Random(5)
    lists = [[rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000), 28705, 260]) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    offsets = np.cumsum([0] + [len(x) for x in lists])
    for ids, text in zip(lists, own.decode(np.array([i for x in lists for i in x], np.int64), offsets), strict=True):
        assert text.decode() == library.decode(ids), ids


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 10)
    own, fresh, some = P.Codec(P.model_bytes()), P.Codec(P.model_bytes()), texts(60, 6)
    for text in some:
        for a, b in zip(own.encode([text]), fresh.encode([text]), strict=True):
            assert a.tolist() == b.tolist()


def test_query_equals_the_library(spark):
    library = spm.SentencePieceProcessor(model_proto=P.model_bytes())
    docs = brute.table("documents")
    rows = {r["doc_id"]: r for r in P.op13_pieces(spark, brute.SMALL).collect()}
    assert len(rows) == len(docs)
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert want == (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"])


def test_edges(spark, edge, empty):
    library = spm.SentencePieceProcessor(model_proto=P.model_bytes())
    out = P.decode(P.encode(edge))
    assert out.columns == [c for c in edge.columns if c != "ids"] + ["ids", "begins", "ends", "decoded"]
    rows = out.collect()
    assert len(rows) == edge.count()
    for r in rows:
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert r["ids"] == ids and r["decoded"] == library.decode(ids)
        assert len(r["begins"]) == len(r["ends"]) == len(ids) and r["ends"][-1] == len((r["text"] or "").encode())
    assert P.encode(empty).count() == 0 and P.digests(empty).count() == 0
