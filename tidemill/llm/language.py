"""Operator 6. Language ID by compression.

For each language a raw-content zstandard dictionary is made from a bounded
sample of its labelled passages. A text belongs to the language whose
dictionary compresses it best. The verdict is rejected when the second-best
language comes too near.

Texts are reduced to lower-case letters and single spaces and compressed in
blocks, so a long text is scored whole, at the same cost per character, and
its own earlier parts do not drown the dictionary.

Defined cases: a null text, an empty one and one without a letter is ``und``
with score 0, rejected; sizes that tie are measured again behind a filler, for
texts of any length, and sizes that still tie go to the language first in
code-point order and are rejected; with no labelled row at all every text is
``und``; rows with a null language are never learned from; other columns are
untouched.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import held_out, kept, open_table

UNDEFINED = "und"
#: Bound of the sample the dictionaries are made of: passages a language, code points a passage.
PASSAGES, PASSAGE_CHARS = 400, 400
#: Languages at most; more are an error, never a cut. With the bound above, at most 41 million code points are collected and broadcast.
MAX_LANGS = 256
BLOCK = 4096
LEVEL = 5
FILLER = 32
#: The second-best size must exceed the best by this share of it, or the verdict is rejected.
MARGIN = 0.002

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str | None) -> bytes:
    """Lower-case letters and single spaces, UTF-8; empty if the text has no letter."""
    if not text:
        return b""
    flat = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, flat)):
        return b""
    return flat.encode("utf-8", "replace")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionary bytes by language, from a bounded sample of passages drawn by the text's hash."""
    rows = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).filter("t IS NOT NULL AND t <> '' AND l IS NOT NULL")
    # Copies of a text are drawn together, so shares are of the different texts.
    counts = rows.groupBy("l").agg(F.approx_count_distinct(F.xxhash64("t")).alias("texts")).limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return {}
    spark = docs.sparkSession
    space = 1 << 40
    # Four times the wanted number is drawn, since the count is approximate.
    keep = [(r["l"], space if r["texts"] <= 8 * PASSAGES else space * 4 * PASSAGES // r["texts"]) for r in counts]
    shares = spark.createDataFrame(keep, "l string, below long")
    drawn = (
        rows.withColumn("h", F.xxhash64("t"))
        .join(F.broadcast(shares), "l")  # at most MAX_LANGS short rows
        .filter(F.pmod("h", F.lit(space)) < F.col("below"))
        # A passage from a place in the text that the hash picks; a short text whole.
        .withColumn("at", F.pmod(F.shiftright("h", 7), F.greatest(F.lit(1).cast("long"), F.length("t") - PASSAGE_CHARS)))
        .select("l", "h", F.expr(f"substring(t, cast(at as int) + 1, {PASSAGE_CHARS})").alias("p"))
        .dropDuplicates(["l", "h"])
    )
    by_hash = Window.partitionBy("l").orderBy("h")  # at most about 8 * PASSAGES short passages a language
    first = drawn.withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= PASSAGES)
    passages: dict[str, list[tuple[int, str]]] = {}
    for r in first.select("l", "n", "p").collect():  # at most MAX_LANGS * PASSAGES passages
        passages.setdefault(r["l"], []).append((r["n"], r["p"]))
    return {k: b" ".join(normal(p) for _, p in sorted(v)) for k, v in sorted(passages.items())}


class Model:
    """Compressors by language, made once a Python worker."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.compressors, self.fillers = [], []
        for name in self.names:
            data = dictionaries[name]
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(data) >= 8 else None
            if raw is not None:
                raw.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
            )
            filler = data[len(data) // 2 :][:FILLER]
            self.fillers.append((filler, len(self.compressors[-1].compress(filler))))

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): score is the best size's weight against the others, each byte more halving a weight."""
        data = normal(text)
        if not data or not self.names:
            return UNDEFINED, 0.0, 0.0
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]
        best = min(sizes)
        if sizes.count(best) > 1:
            # zstandard stores a text of a few words as it is. Behind a passage of the dictionary's own, which makes the
            # block worth compressing, even a few words show their cost.
            sizes = [sum(len(c.compress(f + b)) - n for b in blocks) for c, (f, n) in zip(self.compressors, self.fillers, strict=True)]
            sizes = [s + max(0, 1 - min(sizes)) for s in sizes]
            best = min(sizes)
        at = sizes.index(best)
        weight = sum(2.0 ** -min(60, s - best) for s in sizes)
        second = min((s for i, s in enumerate(sizes) if i != at), default=2 * best)
        return self.names[at], 1.0 / weight, (second - best) / best


def judge_column(spark: SparkSession, dictionaries: dict[str, bytes], text: str = "text") -> Column:
    """struct(lang, score, margin, rejected) of a text column; every text is read whole."""
    shared = spark.sparkContext.broadcast(dictionaries)  # at most MAX_LANGS * PASSAGES passages
    key = hashlib.md5(repr(sorted(dictionaries.items())).encode()).hexdigest()

    @F.pandas_udf("lang string, score double, margin double, rejected boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        own = kept(__name__)
        made = own.get(key)
        if made is None:
            own.clear()
            made = own[key] = Model(shared.value)
        out = [made.judge(t) for t in texts]
        frame = pd.DataFrame(out, columns=["lang", "score", "margin"])
        frame["rejected"] = (frame["lang"] == UNDEFINED) | (frame["margin"] < MARGIN)
        return frame

    return judge(F.col(text))


def learn_from_open(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionaries from the rows that are not held out."""
    return learn(docs.filter(~held_out(doc_id)), text, lang)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; ``rejected`` marks narrow margins and ``und``."""
    docs = open_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    verdict = judge_column(spark, learn_from_open(docs))
    found = docs.select("doc_id", held_out("doc_id").alias("held_out"), verdict.alias("v"))
    return found.select("doc_id", "held_out", F.col("v.lang").alias("lang_pred"), F.col("v.score").alias("score"), F.col("v.rejected").alias("rejected"))
