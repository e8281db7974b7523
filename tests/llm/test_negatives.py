from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemill.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, keep=5):
    """Sorted result rows straight from the definition."""
    sound = [(i, v, y) for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    part = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in sound]
    out = []
    for i, v, y in {p for p in part if p[0] is not None and p[0] % 100 == 0}:
        scored = [(sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in part]
        order = lambda s: (-s[0], s[1] is None, s[1] or 0)
        for score, j, _ in sorted((s for s in scored if s[2] == y and s[1] != i), key=order)[:keep]:
            window = sorted((s for s in scored if s[2] != y and 80 * score <= 100 * s[0] <= 100 * score), key=order)[:keep]
            out += [(i, j, k + 1, n, score, s) for k, (s, n, _) in enumerate(window)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    found = N.mine(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found), key=repr)


def random_rows(n, seed, step=0.125):
    """Coarse components: many equal scores."""
    rng = random.Random(seed)
    return [(i * 5, [rng.randint(-8, 8) * step for _ in range(6)], rng.randint(0, 3)) for i in range(n)]


def test_lists_equal_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(60):
        n = int(rng.integers(1, 300))
        vectors = rng.integers(-9, 10, (n, int(rng.integers(1, 7))))
        anchor, fits, rank = rng.integers(-9, 10, vectors.shape[1]), rng.random(n) < 0.7, rng.permutation(n)
        scores = vectors @ anchor
        windows = [(None, None)] + [(int(a), int(a) + 40) for a in rng.integers(-50, 150, 3)]
        lists = N.Lists(vectors, int(np.abs(anchor).sum()))
        for (low, high), (rows, found) in zip(windows, lists.best(anchor, fits, rank, windows, 5), strict=True):
            want = [r for r in range(n) if fits[r] and (low is None or low <= scores[r] <= high)]
            want.sort(key=lambda r: (-scores[r], rank[r]))
            assert rows.tolist() == want[:5] and found.tolist() == scores[want[:5]].tolist()


def test_the_threshold_stops_early(monkeypatch):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-20, 21, (4000, 8))
    vectors[:8] = 200  # a few rows far above the rest
    lists, asked = N.Lists(vectors, 1600), []
    scores = lists.scores
    monkeypatch.setattr(lists, "scores", lambda rows, anchor: (asked.append(len(rows)), scores(rows, anchor))[1])
    anchor = np.full(8, 200)
    (rows, _), = lists.best(anchor, np.ones(4000, bool), np.arange(4000), [(None, None)], 5)
    assert rows.tolist() == [0, 1, 2, 3, 4] and sum(asked) < 400


def test_large_components_stay_exact():
    vectors = np.array([[1 << 40, 1], [1 << 40, 2], [0, 0]])
    lists = N.Lists(vectors, (1 << 20) + 1)
    assert not lists.exact
    (rows, scores), = lists.best(np.array([1 << 20, 1]), np.ones(3, bool), np.arange(3), [(None, None)], 2)
    assert rows.tolist() == [1, 0] and scores.tolist() == [(1 << 60) + 2, (1 << 60) + 1]


@pytest.mark.parametrize("blocks", [(1 << 16, 1 << 12, 2048), (40, 3, 10)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("CANDIDATES", "ANCHORS", "LEAST"), blocks, strict=True):
        monkeypatch.setattr(N, name, value)
    rows = random_rows(240, 3)
    got = mined(spark, rows)
    assert got and got == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(60, 4)
    rows += [(100, None, 1), (200, [0.5, nan], 1), (300, [inf, 0.0], 1), (400, [0.5, None], 2), (500, [0.5] * 6, None)]
    rows += [(None, [0.5] * 6, 1), (None, [0.5] * 6, 2), (600, [], 1), (700, [0.25, 0.5], 3)]
    rows += [rows[20], rows[20], (rows[20][0], [0.125] * 6, 2)]  # an anchor three times, once with another vector
    rows += [(9000 + i, [0.5, -0.5, 0.5, 0.5, 0.0, 0.0], 2) for i in range(50)]  # one vector, fifty ids
    assert mined(spark, rows) == brute(rows)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == [] and mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_extra_columns_clash_with_nothing(spark):
    from pyspark.sql import functions as F

    rows = random_rows(60, 6)
    clash = ["e_id", "e_key", "e_vec", "e_copy", "ab", "cb", "window", "score", "rank", "x", "targets"]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("theirs") for c in clash})
    assert N.mine(frame).count() == len(brute(rows))
