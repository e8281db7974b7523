from __future__ import annotations

import collections

import pyarrow as pa
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from tests.llm import brute
from tidemill.llm import bpe, common, mixing
from tidemill.llm.common import stored


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    kept = {}
    for name, stage in C.STAGES:
        docs = stored(stage(spark, docs, brute.SMALL), f"test-{name}")
        kept[name] = [r.asDict() for r in docs.collect()]
        if name != "encoding":
            assert docs.columns == list(C.COLUMNS)
            assert all(r["n_chars"] == len(r["text"]) for r in kept[name])
    source = brute.table("documents").set_index("doc_id")

    first = kept["language"]
    assert len(first) >= 0.97 * len(source)
    want = brute.classes([r["doc_id"] for r in first], [r["text"] for r in first])
    second = kept["near_duplicates"]
    assert sorted(r["doc_id"] for r in second) == sorted(set(want.values()))
    assert all(r["text"] == source.text[r["doc_id"]] for r in second)

    third = {r["doc_id"]: r["text"] for r in kept["substrings"]}
    assert len(third) == len(second)
    for r, (w, rest) in zip(second, brute.repeats([r["text"] for r in second], 35)):
        assert third[r["doc_id"]] == (r["text"] if len(rest) == len(w) else " ".join(rest))

    copies = collections.Counter(r["doc_id"] for r in kept["mixing"])
    frame = spark.createDataFrame(kept["substrings"], "doc_id long, text string, lang string, source string, n_chars long")
    assert copies == {r["m_id"]: r["m_copies"] for r in mixing.mix_sources(frame).collect() if r["m_copies"]}

    library = Tokenizer.from_str(bpe.vocabulary_text())
    assert collections.Counter(r["doc_id"] for r in kept["encoding"]) == copies
    for r in kept["encoding"]:
        assert r["ids"] == library.encode(third[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_stages_take_edge_rows_and_empty_tables(spark, edge, empty):
    for name, stage in C.STAGES:
        assert stage(spark, empty, brute.SMALL).count() == 0, name
        assert stage(spark, edge, brute.SMALL).count() >= 0, name


def test_registered():
    queries = E.queries()
    assert "pipeline" in queries
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in queries) == 1


def test_worker_keeps_one_operators_things():
    """A worker that goes on to another operator drops what the last one kept, be that a codec or hash tables."""
    common.kept("tidemill.llm.bpe")["key"] = "a codec"

    def run(batches):
        yield from batches

    run.__module__ = "tidemill.llm.bpe"
    assert [*common.released(run)(iter([1]))] == [1] and common.kept("tidemill.llm.bpe") == {"key": "a codec"}
    run.__module__ = "tidemill.llm.substrings"
    assert [*common.released(run)(iter([1]))] == [1] and common.kept("tidemill.llm.bpe") == {}


def test_texts_are_worked_on_in_small_slices():
    """A slice, whose arrays are many times its size, is a megabyte of text; a longer text is one of its own."""
    texts = pa.array(["x" * 300_000] * 10 + ["y" * 3_000_000] + [""] * 5)
    parts = [texts.slice(a, b - a).to_pylist() for a, b in common.text_slices(texts)]
    assert [t for part in parts for t in part] == texts.to_pylist()
    assert all(len(part) == 1 or sum(map(len, part)) <= 1 << 20 for part in parts)
