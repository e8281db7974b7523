from __future__ import annotations

import collections
import math

from pyspark.sql import functions as F

from tests.llm import brute
from tidemill.llm import rules as R


def counts(text):
    w = brute.words(text)
    grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if brute.WORD.search(line):
            twice += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, twice, len(covered)


def buckets(text):
    h = [brute.xx(w) for w in brute.words(text)]
    return [x & (R.BUCKETS - 1) for x in h + [brute.xx(a, b) for a, b in zip(h, h[1:])]]


def weights(texts, good):
    raw, target = collections.Counter(), collections.Counter()
    for t, g in zip(texts, good):
        raw.update(buckets(t))
        if g:
            target.update(buckets(t))
    share = lambda c, b: math.log((c[b] + 1) / (sum(c.values()) + R.BUCKETS))
    return lambda b: share(target, b) - share(raw, b) if sum(target.values()) else 0.0


def check(rows, texts, good):
    weight = weights(texts, good)
    cache = {b: weight(b) for t in texts for b in buckets(t)}
    for text, r in zip(texts, rows):
        assert counts(text) == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        grams = buckets(text)
        ratio = math.fsum(cache[b] for b in grams) / max(1, len(grams))
        assert abs(ratio - r["ratio"]) < 1e-9
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert (r["base_failed"], r["kept"]) == (failed, not failed and ratio >= R.THRESHOLD)


def test_query_equals_brute_force(spark):
    docs, labels = brute.table("documents"), brute.table("labels")
    good = set(labels[labels.quality == 1].doc_id)
    rows = {r["doc_id"]: r for r in R.op1_rules(spark, brute.SMALL).collect()}
    assert len(rows) == len(docs)
    check([rows[i] for i in docs.doc_id], list(docs.text), [i in good for i in docs.doc_id])


def test_junk_goes_and_clean_documents_stay(spark):
    labels = brute.table("labels", brute.CHECK).set_index("doc_id").quality
    rows = [r for r in R.op1_rules(spark, brute.CHECK).collect() if r["doc_id"] in labels.index and not r["base_failed"]]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1]
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.25


def test_edges(spark, edge, empty):
    no_labels = spark.createDataFrame([], "doc_id long")
    out = R.judge(edge, R.log_ratios(edge, no_labels)).collect()
    assert len(out) == edge.count() and {r["ratio"] for r in out} == {0.0}
    by_id = {r["g_id"]: r for r in out}
    assert (by_id[2]["n_words"], by_id[2]["base_failed"], by_id[2]["kept"]) == (0, True, False)
    assert R.judge(empty, R.log_ratios(empty, no_labels)).count() == 0
    trusted = spark.createDataFrame([(7,), (None,)], "doc_id long")
    rows = R.judge(edge, R.log_ratios(edge, trusted)).orderBy("n_words", "g_id").collect()
    source = edge.select("doc_id", "text").withColumn("n", F.size(F.expr(r"regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0)")))
    texts = source.orderBy("n", "doc_id").collect()
    check(rows, [t["text"] for t in texts], [t["doc_id"] == 7 for t in texts])


def test_the_target_is_counted_on_every_trusted_row(spark, monkeypatch):
    """With all rows trusted both multinomials are equal, at any number of rows and by either join."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("one word").alias("text"))
    for ids in (R.BROADCAST_IDS, 100):
        monkeypatch.setattr(R, "BROADCAST_IDS", ids)
        weights = R.log_ratios(docs, docs).first()["weights"]
        assert len(weights) == R.BUCKETS and max(map(abs, weights)) < 1e-12
