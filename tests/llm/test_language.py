from __future__ import annotations

import random

import pytest
import zstandard

from tests.llm import brute
from tidemill.llm import language as L


def test_held_out_accuracy(spark):
    docs = brute.table("documents", brute.CHECK).set_index("doc_id")
    rows = L.op6_language(spark, brute.CHECK).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = [r["lang_pred"] == docs.lang[r["doc_id"]] for r in held]
    assert sum(right) / len(right) > 0.97
    assert sum(r["rejected"] for r in rows) / len(rows) < 0.02


def test_edges(spark, edge, empty):
    pairs = [("en", "the quick brown fox jumps over the lazy dog and then the end of it all")] * 3
    pairs += [("de", "der schnelle braune fuchs springt über den faulen hund und dann das ende")] * 3 + [(None, "never learned")]
    taught = L.learn(spark.createDataFrame(pairs, "lang string, text string"))
    assert sorted(taught) == ["de", "en"]
    out = [r[0] for r in edge.select(L.judge_column(spark, taught)).collect()]
    assert [(r["lang"], r["score"], r["rejected"]) for r in out[1:4]] == [("und", 0.0, True)] * 3
    assert out[7]["lang"] == "und"  # digits and marks, no letter
    assert out[0]["lang"] in ("de", "en")
    frame = spark.createDataFrame([("the lazy dog and the brown fox",), ("der faule hund und das ende",), ("é",), ("漢字",)], "text string")
    found = [r[0]["lang"] for r in frame.select(L.judge_column(spark, taught)).collect()]
    assert found[:2] == ["en", "de"] and "und" not in found
    assert L.learn(empty) == {}
    none = [r[0]["lang"] for r in edge.select(L.judge_column(spark, {})).collect()]
    assert set(none) == {"und"}
    assert empty.select(L.judge_column(spark, taught)).count() == 0


def test_ties_are_rejected(spark):
    same = {"aa": b"the same passage here", "bb": b"the same passage here"}
    (row,) = spark.createDataFrame([("the same passage",)], "text string").select(L.judge_column(spark, same)).collect()
    assert row[0]["lang"] == "aa" and row[0]["rejected"] and row[0]["score"] == 0.5


def test_whole_texts_are_scored(spark):
    """What stands behind a long beginning still decides."""
    docs = spark.read.parquet(f"{brute.CHECK}/documents.parquet")
    model = L.Model(L.learn_from_open(docs))
    table = brute.table("documents", brute.CHECK)
    join = lambda lang: " ".join(table[table.lang == lang].text.head(30))
    en, de = join("en"), join("de")
    assert model.judge(en[:20_000] + " " + de[:60_000])[0] == "de"


def test_copies_do_not_eat_the_sample(spark):
    """A text copied thousands of times beside a thousand different ones: the dictionary is made of as many passages."""
    from pyspark.sql import functions as F

    copies = spark.range(400_000).select(F.lit("en").alias("lang"), F.lit("the same text again and again").alias("text"))
    texts = spark.range(1000).select(F.lit("en"), F.concat(F.lit("number"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")))
    words = set(L.learn(copies.union(texts))["en"].decode().split())
    assert len([w for w in words if w.startswith("number")]) >= L.PASSAGES - 1


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ", "".join(map(chr, range(0x4E00, 0x4F00)))])
def test_every_script_keeps_all_its_passages(spark, letters):
    """One, two and three bytes a letter: as many passages of as many letters, and the first of them still helps."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice(letters) for _ in range(7))
    texts = [" ".join(word() for _ in range(70)) for _ in range(900)]
    taught = L.learn(spark.createDataFrame([("xx", t) for t in texts], "lang string, text string"))
    data = taught["xx"].decode()
    assert L.PASSAGES * (L.PASSAGE_CHARS - 2) <= len(data) <= L.PASSAGES * (L.PASSAGE_CHARS + 1)
    every = set(" ".join(texts).split())
    assert len(every & set(data.split())) > 0.9 * L.PASSAGES * L.PASSAGE_CHARS / 8
    model = L.Model(taught)
    plain = zstandard.ZstdCompressor(level=L.LEVEL)
    for at in (8, len(data) // 2, len(data) - 300):
        part = data[at : at + 250].encode()
        assert len(model.compressors[0].compress(part)) < len(plain.compress(part)) / 4


def judged(dictionaries, text):
    """The verdict from the method's description, with compressors of its own."""
    data = L.normal(text)
    if not data or not dictionaries:
        return "und", 0.0, 0.0, True
    names = sorted(dictionaries)

    def cost(name, block):
        raw = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=L.LEVEL)
        return len(zstandard.ZstdCompressor(level=L.LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False).compress(block))

    blocks = [data[i : i + L.BLOCK] for i in range(0, len(data), L.BLOCK)]
    sizes = {n: sum(cost(n, b) for b in blocks) for n in names}
    if sorted(sizes.values())[1:2] == [min(sizes.values())]:
        fill = {n: dictionaries[n][len(dictionaries[n]) // 2 :][: L.FILLER] for n in names}
        sizes = {n: sum(cost(n, fill[n] + b) - cost(n, fill[n]) for b in blocks) for n in names}
        least = min(sizes.values())
        sizes = {n: s + max(0, 1 - least) for n, s in sizes.items()}
    order = sorted(names, key=lambda n: (sizes[n], n))
    best = sizes[order[0]]
    margin = ((sizes[order[1]] if len(names) > 1 else 2 * best) - best) / best
    return order[0], 1 / sum(2.0 ** -min(60, s - best) for s in sizes.values()), margin, margin < L.MARGIN


def test_every_verdict_equals_brute_force(spark):
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    taught = L.learn_from_open(docs)
    rows = {r["doc_id"]: r for r in L.op6_language(spark, brute.SMALL).collect()}
    table = brute.table("documents")
    some = table.sample(60, random_state=1)  # the plain form builds its compressors for each block
    extra = [None, "", "a", "the", "1234", "the der die le la"]
    found = [r[0] for r in spark.createDataFrame([(t,) for t in extra], "text string").select(L.judge_column(spark, taught)).collect()]
    for text, r in zip(extra, found, strict=True):
        name, score, margin, rejected = judged(taught, text)
        assert (r["lang"], r["rejected"]) == (name, rejected) and r["score"] == pytest.approx(score) and r["margin"] == pytest.approx(margin)
    for i, text in zip(some.doc_id, some.text, strict=True):
        name, score, _, rejected = judged(taught, text)
        assert (rows[i]["lang_pred"], rows[i]["rejected"]) == (name, rejected) and rows[i]["score"] == pytest.approx(score)


def test_ties_of_long_texts_follow_the_same_rule():
    """Dictionaries alike but for what the filler shows: a text of several blocks is measured again too."""
    same = b"the same passage here"
    model = L.Model({"aa": same, "bb": same})
    for text in ("the same passage", "the same passage " * 2000):
        name, score, margin = model.judge(text)
        assert (name, score, margin < L.MARGIN) == ("aa", 0.5, True)
    calls = []
    model.fillers = [(b"first", 1), (b"other", 1)]

    class Spy:
        def compress(self, block):
            calls.append(block)
            return b"0123456789"

    model.compressors = [Spy(), Spy()]
    model.judge("ab " * 4000)
    assert sum(c.startswith((b"first", b"other")) for c in calls) == len(calls) // 2 == 2 * -(-11_999 // L.BLOCK)
