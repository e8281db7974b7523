from __future__ import annotations

import numpy as np

from tests.llm import brute
from tidemill.llm import quality as Q


def test_held_out_accuracy(spark):
    labels = brute.table("labels", brute.CHECK).set_index("doc_id").quality
    rows = Q.op7_quality(spark, brute.CHECK).collect()
    assert len(rows) == len(brute.table("documents", brute.CHECK))
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels.index]
    assert sum(p == y for p, y in held) / len(held) > 0.95


def test_score_is_a_sum_of_table_lookups():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, len(Q.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # nothing but a pairwise interaction
    model = Q.Gam().fit(x, y)
    got = model.score(x)
    assert ((got > 0.5) == y).mean() > 0.9 and (0, 1) in model.pairs
    one = model.base + sum(t[np.searchsorted(c, x[5, f])] for f, (c, t) in enumerate(zip(model.cuts, model.tables)))
    one += sum(t[tuple(np.searchsorted(model.pair_cuts[k], x[5, k]) for k in fg)] for fg, t in model.pairs.items())
    assert abs(got[5] - 1 / (1 + np.exp(-one))) < 1e-12


def test_edges(spark, edge, empty):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.learn(edge, nothing)
    assert {r[0] for r in edge.select(Q.score_column(model)).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 1), (99, 0)], "doc_id long, quality int")
    scores = {r[0] for r in edge.select(Q.score_column(Q.learn(edge, labels))).collect()}  # one class only
    assert scores == {3 / 4}
    assert empty.select(Q.score_column(model)).count() == 0
    assert Q.features(None) == Q.features("") == [0.0] * len(Q.FEATURES)
    assert all(np.isfinite(Q.features(t)).all() for t in ("   ", "\n\n", "a", "é" * 1000, "!" * 100_000, "\ud800"))


def test_an_id_that_repeats_gives_one_training_row(spark, monkeypatch):
    """A third of all rows share one labelled id: one of them is learned from, the same one in any order."""
    seen = []
    fit = Q.Gam.fit
    monkeypatch.setattr(Q.Gam, "fit", lambda self, x, y: seen.append((x.tolist(), y.tolist())) or fit(self, x, y))
    docs = spark.range(1500).selectExpr("IF(id < 500, 7, id) AS doc_id", "concat('some words of text number ', id, repeat(' more', CAST(id % 9 AS INT))) AS text")
    labels = spark.range(0, 1500, 3).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality").union(spark.sql("SELECT 7L, 1"))
    Q.learn(docs, labels)
    Q.learn(docs.repartition(5), labels)
    assert seen[0] == seen[1]
    ids = {7} | {i for i in range(500, 1500) if i % 3 == 0}
    assert len(seen[0][1]) == len(ids)
