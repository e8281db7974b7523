from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidemill.llm import substrings as S
from tidemill.llm import wordhash as W


def check(frame, texts, width):
    rows = S.remove_repeats(frame, width=width, digest=True).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows}
    for i, (w, kept) in enumerate(brute.repeats(texts, width)):
        assert got[i] == (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()), i


def test_query_equals_brute_force(spark):
    docs = brute.table("documents")
    rows = {r["doc_id"]: r for r in S.op8_substrings(spark, brute.SMALL).collect()}
    assert len(rows) == len(docs)
    gone = 0
    for i, (w, kept) in zip(docs.doc_id, brute.repeats(list(docs.text), 35)):
        r = rows[i]
        sha = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), len(w) - len(kept), sha)
        gone += r["n_removed"]
    assert gone > 0


@pytest.mark.parametrize("width", [1, 2, 5, 8])
def test_random_texts(spark, width, monkeypatch):
    """Few words, so that windows repeat in all ways: overlapping, inside a text, across chunks."""
    rng = random.Random(width)
    texts = [" ".join(rng.choice("ab" if rng.random() < 0.3 else "abcdefgh") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(12))
    texts += [f"x{i} {passage} y{i}" for i in range(9)] + [passage, "a" * 3000, None, "", " \n "]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(frame, texts, width)


def test_small_chunks_and_texts_over_several_slices(spark):
    """The same answers whether copies meet in one chunk, in several, or in one text."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    texts = [" ".join(words), " ".join(words[500:900]), " ".join(words[:100] + words[:100]), " ".join(words[100:134])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (1, 4):
        check(frame.repartition(parts), texts, 35)


def messages_of(batches):
    """One message a batch, so that those of a range can be put together."""
    return [b.slice(i, 1) for b in batches for i in range(b.num_rows)]


@pytest.mark.parametrize("least, places", [(S.CHUNK // 2, 20_000), (3 * S.CHUNK // 4, 20_000), (S.CHUNK, 3)])
def test_dealt_by_groups_of_ranges(spark, monkeypatch, least, places):
    """Two levels of dealing, and several ranges a partition, remove the same words."""
    monkeypatch.setattr(S, "LEAST", least)
    monkeypatch.setattr(S, "PLACES", places)
    assert S._fan(int(spark.conf.get("spark.sql.shuffle.partitions"))) > 1
    rng = random.Random(least)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))) for _ in range(150)] + ["", None]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6), texts, 5)


def sent(ranges):
    """Bytes a window that a chunk of random windows sends, and that a merger of a table of this size sends on."""
    rng, fan = np.random.default_rng(ranges), S._fan(ranges)
    hashes = S._ranged(rng.integers(0, 1 << 63, S.CHUNK, dtype=np.uint64), ranges)
    size = sum(len(x) for m in S._probe_chunk(ranges, fan, 0, [7], [(hashes, np.zeros(len(hashes[::18]), int), hashes[::18])]) for x in m.column(2).to_pylist())
    if fan == 1:
        return size / S.CHUNK, 0.0
    each, blobs, windows = S.CHUNK * fan // ranges, [], 0
    while windows < S.RANGE_BYTES // 6:  # windows of as much text as a range stands for reach a merger, in blobs of this size
        at = np.sort(rng.integers(0, fan << 32, each, dtype=np.uint64))
        blobs.append(S.pack(S._steps(at), np.packbits(np.zeros(each, bool)), S._steps(at[::18]), np.zeros(len(at[::18]), np.uint32), np.array([7])))
        windows += each
    return size / S.CHUNK, sum(len(x) for m in S._merge_blocks(ranges, fan)(0, blobs) for x in m.column(2).to_pylist()) / windows


def test_bytes_a_window_at_any_number_of_ranges():
    """A window costs a few bytes a hop, however many ranges there are; only the length of its hash grows, by bits."""
    few, many, most = sent(100), sent(100_000), sent(1_000_000)
    assert few[0] < 3.5 and few[1] == 0
    assert many[0] < 5 and many[1] < 4, many
    assert most[0] < 6 and most[1] < 5, most


def test_chunks_settle_and_tell_each_other():
    """Driver-side: several tiny chunks of windows give the ranges the same findings as one."""
    texts = pa.array(["a b c d e f g h", "x c d e f y", "c d e f", "q r s t"])
    w = W.split_words(texts)
    hashes = W.Hasher(1).windows(W.Hasher(1).words(w), 2)
    ok = W.inside(w.ends, 2)
    docs = w.docs()[: len(ok)]
    block = ok & ((np.arange(len(ok)) - w.ends[docs]) % 2 == 0)
    ranged = S._ranged(hashes, 3)
    answers = []
    for groups in ([[0, 1, 2, 3]], [[0], [1], [2], [3]], [[0, 1], [2, 3]]):
        messages = []
        for g in groups:
            inside = ok & np.isin(docs, g)
            found = [(ranged[inside], docs[block & inside], ranged[block & inside])]
            messages += list(S._probe_chunk(3, 1, 0, list(range(100, 104)), found))
        found = set()
        for batch in S._by_range(S._matched(S._match_blocks, 3))(iter(sorted(messages_of(messages), key=lambda m: m.column(0)[0].as_py()))):
            for blob in batch.column(2).to_pylist():
                found |= set(zip(*(x.tolist() for x in S.unpack(blob, np.int64, np.int64))))
        answers.append(found)
    assert answers[0] == answers[1] == answers[2] and answers[0]


def test_pack_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        a, b = rng.integers(0, 1 << 60, n, dtype=np.uint64), rng.integers(0, 200, n).astype(np.uint8)
        x, y = S.unpack(S.pack(a, b), np.uint64, np.uint8)
        assert np.array_equal(a, x) and np.array_equal(b, y)


def test_edges(spark, edge, empty):
    rows = S.remove_repeats(edge)
    assert rows.columns == [c for c in edge.columns if c not in ("text", "n_words", "n_removed")] + ["n_words", "n_removed", "text"]
    texts = [r["text"] for r in edge.collect()]
    got = sorted((r["n_words"], r["n_removed"], r["text"]) for r in rows.collect())
    want = [(len(w), len(w) - len(k), (t or "") if len(w) == len(k) else " ".join(k)) for t, (w, k) in zip(texts, brute.repeats(texts, 35))]
    assert got == sorted(want)  # texts that lose nothing stay as they are
    assert S.remove_repeats(empty).count() == 0


def test_equal_rows_are_two_places(spark):
    text = " ".join(f"w{i}" for i in range(40))
    frame = spark.createDataFrame([(1, text), (1, text), (2, text[:-4])], "doc_id long, text string")
    assert [r["n_removed"] for r in S.remove_repeats(frame).orderBy("doc_id").collect()] == [40, 40, 39]


def test_word_hashes():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é\n\t\x0b漢 ") for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["", "z" * 5000]
    hasher = W.Hasher(1)
    w = W.split_words(pa.array(["skipped"] + texts)[1:])
    hashes = hasher.words(w)
    seen = {}
    for i, t in enumerate(texts):
        own = hashes[w.ends[i] : w.ends[i + 1]].tolist()
        assert len(own) == len(brute.words(t))
        for a, b in zip(brute.words(t), own):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)
