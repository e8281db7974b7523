from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm import brute
from tidemill.llm import neardup as N


def test_query_equals_brute_force(spark):
    docs = brute.table("documents")
    want = brute.classes(list(docs.doc_id), list(docs.text))
    rows = N.op5_neardup(spark, brute.SMALL).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == want and len(rows) == len(docs)
    sizes = {i: sum(1 for x in want.values() if x == i) for i in want.values()}
    assert all(r["class_size"] == sizes[r["class_id"]] for r in rows)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.random()}"
    return out


def test_groups_of_near_copies(spark):
    """A large group, a chain whose ends are unlike, moved halves, and short texts."""
    rng = random.Random(5)
    text = [f"w{rng.randrange(5000)}" for _ in range(400)]
    texts = [" ".join(edited(rng, text, 3)) for _ in range(60)]
    chain = [f"c{i}" for i in range(300)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 5)
    moved = [f"m{i}" for i in range(200)]
    texts += [" ".join(moved), " ".join(moved[100:] + moved[:100])]
    texts += ["a b c", "a b c", "a b d", "one", "", "", "x " * 50, "x " * 51, "x " * 20]
    ids = list(range(100, 100 + len(texts)))
    frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r["n_id"]: r["class_id"] for r in N.near_duplicates(frame).collect()}
    want = brute.classes(ids, texts)
    assert got == want
    assert len({got[i] for i in ids[:60]}) == 1 and got[ids[72]] != got[ids[73]]
    kept = N.keep_one(frame).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))
    assert all(r["text"] == texts[r["doc_id"] - 100] for r in kept)


def test_a_large_bucket_in_many_small_classes(spark):
    """Pairs in one template: most of what a pair shares, all the others have too."""
    rng = random.Random(8)
    template = " ".join(f"t{i}" for i in range(178))
    texts = []
    for i in range(100):
        both = " ".join(f"p{i}x{rng.random()}" for _ in range(6))
        texts += [" ".join([template, both, *(f"o{rng.random()}" for _ in range(20))]) for _ in range(2)]
    ids = list(range(len(texts)))
    want = brute.classes(ids, texts)
    assert len(set(want.values())) == 100
    frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    assert {r["n_id"]: r["class_id"] for r in N.near_duplicates(frame).collect()} == want


def test_short_texts(spark):
    """A text of 6 to 60 words beside the same text with a word more, and others around."""
    rng = random.Random(9)
    texts = []
    for i in range(6, 61):
        for k in range(10 if i < 12 else 2):
            words = [f"s{i}x{k}x{j}" for j in range(i)]
            texts += [" ".join(words), " ".join([*words, "more"]), " ".join(edited(rng, words, 1))]
    ids = list(range(len(texts)))
    frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r["n_id"]: r["class_id"] for r in N.near_duplicates(frame).collect()}
    assert got == brute.classes(ids, texts)
    eight = texts.index(" ".join(f"s8x0x{j}" for j in range(8)))
    assert got[eight] == got[eight + 1]


def test_alignment_is_exact_above_the_threshold():
    rng = random.Random(6)
    for _ in range(300):
        a = rng.sample(range(1000), rng.randint(1, 60))
        b = [x for x in a if rng.random() < 0.9] + rng.sample(range(1000, 2000), rng.randint(0, 6))
        if rng.random() < 0.3:
            k = rng.randrange(len(b)) if b else 0
            b = b[k:] + b[:k]
        if not b:
            continue
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        s = table[-1][-1]
        true = s / (len(a) + len(b) - s)
        got = N.alignment(np.array(a, np.uint32), np.array(b, np.uint32))
        assert got == true if true >= N.LIKE else got < N.LIKE


def test_samples_depend_on_the_text_alone():
    texts = ["the same words in one order and then some more", "x", "", "a b a b a b a b a b a b"]
    hashes, ends = N.kmers(pa.array(texts))
    alone = [N.samples(*N.kmers(pa.array([t]))) for t in texts]
    assert np.array_equal(N.samples(hashes, ends), np.concatenate(alone))
    assert ends.tolist() == np.cumsum([0] + [len(brute.labelled_kmers(t)) for t in texts]).tolist()
    assert len(set(hashes.tolist())) == len(hashes)  # repeats are told apart by their number


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11), (20, 21), (21, 22), (20, 22)]
    got = {r["node"]: r["comp"] for r in N.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20}


def test_edges(spark, edge, empty):
    rows = N.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    by_id = {r["n_id"]: (r["class_id"], r["class_size"]) for r in rows}
    assert by_id[5] == (5, 2) and by_id[2] == by_id[3] == (2, 2)  # a repeated row, and null with the empty text
    assert by_id[7] == (7, 1) and by_id[None] == (None, 1)
    kept = N.keep_one(edge)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 2
    assert N.near_duplicates(empty).count() == 0 and N.keep_one(empty).columns == edge.columns
