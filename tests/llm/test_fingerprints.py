from __future__ import annotations

import collections
import hashlib

from tests.llm import brute
from tidemill.llm import fingerprints as P

MASK = (1 << P.PLACE_BITS) - 1


def fingerprint(text):
    h = [brute.xx(w) for w in brute.words(text)]
    if not h:
        return []
    k = P.SHINGLE
    runs = []
    for i in range(max(1, len(h) - k + 1)):
        seed = 42
        for x in h[i : i + k]:  # what lies beyond a short text leaves the hash as it is
            seed = brute.xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), seed)
        runs.append(brute.signed(seed))
    seen, packed = collections.Counter(), []
    for i, x in enumerate(runs):
        top = x & ~MASK
        n = seen[top]
        seen[top] += 1
        packed.append((relabel(top, n) if n else top) | i)
    packed.sort()
    out = []
    for point in P._POINTS:
        at = sum(1 for e in packed if e < point)
        turned = sorted(brute.signed((e & MASK) << 40 | ((e & (1 << 64) - 1) >> P.PLACE_BITS)) for e in (packed[(at + j) % len(packed)] for j in range(P.MINIMA)))
        seed = 42
        for t in turned:
            seed = brute.xxhash.xxh64_intdigest((t & (1 << 40) - 1).to_bytes(8, "little"), seed)
        out.append(brute.signed(seed) & (1 << 31) - 1)
    return out


def relabel(top, n):
    """Hash of a hash and a 32-bit number."""
    seed = brute.xxhash.xxh64_intdigest((top & (1 << 64) - 1).to_bytes(8, "little"), 42)
    return brute.signed(int_hash(n, seed)) & ~MASK


def int_hash(n, seed):
    return brute.xxhash.xxh64_intdigest((n & (1 << 32) - 1).to_bytes(4, "little"), seed)


def text_of(signatures):
    return "".join(f"{x:08x}" for x in signatures)


def likeness(a, b):
    return 1.0 if not a and not b else sum(x == y for x, y in zip(a, b)) / P.SAMPLES


def check(rows, ids, texts):
    """``rows`` by descending id with their texts; every value against plain Python."""
    for k, (i, text) in enumerate(zip(ids, texts)):
        text, after = text or "", texts[(k + 1) % len(texts)] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = fingerprint(text), fingerprint(edited), fingerprint(after)
        want = (len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(a), text_of(b), likeness(a, b), likeness(a, c))
        r = rows[i]
        assert want == (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]), i


def test_query_equals_brute_force(spark):
    docs = brute.table("documents").sort_values("doc_id", ascending=False)
    rows = {r["doc_id"]: r for r in P.op10_fingerprints(spark, brute.SMALL).collect()}
    assert len(rows) == len(docs)
    check(rows, list(docs.doc_id), list(docs.text))
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) > 0.9 * len(rows)


def test_edges(spark, edge, empty, tmp_path):
    def run(frame, name):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return P.op10_fingerprints(spark, f"{tmp_path}/{name}")

    rows = run(edge.filter("doc_id IS NULL OR doc_id <> 5"), "edge").collect()
    by_id = {r["doc_id"]: r for r in rows}
    source = {r["doc_id"]: r["text"] for r in edge.collect()}
    ids = [7, 6, 4, 3, 2, 1, None]  # null last
    assert len(rows) == 7
    check(by_id, ids, [source[i] for i in ids])
    assert run(edge, "repeated").count() == edge.count()
    assert run(empty, "empty").count() == 0
    (one,) = run(edge.filter("doc_id = 1"), "one").collect()
    assert one["near_next"] == 1.0


def test_ids_far_apart(spark, tmp_path):
    ids = [-(1 << 62), -5, 0, 1, 2, 3, 1 << 61, (1 << 61) + 1]
    texts = [f"text number {i} with a few words of its own" for i in ids]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in P.op10_fingerprints(spark, str(tmp_path)).collect()}
    check(rows, ids[::-1], texts[::-1])
