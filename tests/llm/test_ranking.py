from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tidemill.llm import ranking as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=R.TOP):
    """{(item id, text): [(doc id, score), ...]} straight from the formulas."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, words = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = {}
    for item in set(items):
        found = []
        for i, c in counts:
            m = 25 + (75 * c.total() * n_docs) // words
            score = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(item[1]) if t in c)
            if score > 0:
                found.append((i, score))
        out[item] = sorted(found, key=lambda x: (-x[1], x[0] is None, x[0]))[:top]
    return out


def search(spark, docs, items, kind="long", **options):
    d = spark.createDataFrame(docs, f"doc_id {kind}, text string")
    rows = R.search(d, spark.createDataFrame(items, "item_id long, text string"), **options).orderBy("i_id", "i_key", "rank").collect()
    out = {}
    for r in rows:
        out.setdefault((r["i_id"], r["i_key"]), []).append((r["d_id"], r["score"]))
        assert r["rank"] == len(out[(r["i_id"], r["i_key"])])
    return out


def same(got, want):
    filled = {k: v for k, v in want.items() if v}
    assert sorted(map(repr, got.values())) == sorted(map(repr, filled.values()))
    assert sorted(repr(k[0]) for k in got) == sorted(repr(k[0]) for k in filled)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]  # a few words nearly everywhere, many rare ones
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 30)))) for i in range(n)]
    docs += [(5000 + i, docs[3][1]) for i in range(40)]  # a group of copies: ties
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 12)))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("shard", [7, 60, 8192])
def test_equals_brute_force_at_any_shard_size(spark, shard):
    docs, items = corpus(300, shard)
    same(search(spark, docs, items, shard=shard), brute(docs, items))


def test_many_item_blocks_and_another_top(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 4)
    monkeypatch.setattr(R, "BROADCAST_BYTES", 0)  # the items' terms join by a shuffle
    docs, items = corpus(120, 9)
    same(search(spark, docs, items, shard=30, top=3), brute(docs, items, 3))


def test_a_full_flag_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(R, "FLAGS", 2)  # every word passes it
    docs, items = corpus(60, 11)
    same(search(spark, docs, items), brute(docs, items))


def test_edges(spark):
    docs = [(1, "Alpha BETA alpha"), (1, "Alpha BETA alpha"), (None, "alpha"), (2, None), (3, ""), (4, "ÄPFEL äpfel x_y Köln"), (5, " .,! "), (6, "alpha " * 30000)]
    items = [(1, "alpha Alpha äpfel"), (1, "alpha Alpha äpfel"), (1, "ÄPFEL"), (2, None), (3, ""), (4, "nowhere"), (None, "y KÖLN x")]
    got = search(spark, docs, items)
    same(got, brute(docs, items))
    assert sorted(k[0] is None for k in got) == [False, False, True]


def test_text_ids_and_empty_tables(spark):
    docs, items = [("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], [(1, "two")]
    assert list(search(spark, docs, items, "string").values()) == [[(i, s) for i, s in brute(docs, items)[items[0]]]]
    assert search(spark, [], items) == {} and search(spark, docs, [], "string") == {}


def test_extra_columns_clash_with_nothing(spark):
    from pyspark.sql import functions as F

    clash = ["d_row", "d_id", "n", "terms", "tfs", "term", "i_key", "shard", "gain", "score", "rank"]
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string").withColumns({c: F.lit("theirs") for c in clash})
    items = spark.createDataFrame([(1, "two one")], "item_id long, text string").withColumns({c: F.lit("theirs") for c in clash})
    assert [r["d_id"] for r in R.search(docs, items).collect()] == [1]


def test_owners_share_the_postings():
    edges = R._owner_edges([(900, 10), (500, 10), (100, 10), (5, 70)])
    assert len(edges) == R.OWNERS - 1 and edges == sorted(edges, reverse=True)
    assert R._owner_edges([]) == [-1] * (R.OWNERS - 1)
