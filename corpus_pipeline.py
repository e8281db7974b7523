"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Every stage takes all rows its predecessor kept and returns the columns of
documents; the last one returns the encoded corpus. ``n_chars`` follows the
text wherever a stage changes it.

No stage is expressible in SQL (compression, sketches, packed hashes, BPE),
so ``ORACLE_SQL`` is None and tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.bpe import encode
from tidemill.llm.common import open_table, prepared, stored
from tidemill.llm.language import judge_column, learn_from_open
from tidemill.llm.mixing import mixed_rows
from tidemill.llm.neardup import keep_one
from tidemill.llm.substrings import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents whose language stays undecided go. The dictionaries come from the stage's own labelled rows."""
    prepared(spark)
    docs = docs.select(*COLUMNS)
    verdict = judge_column(spark, learn_from_open(docs))
    return docs.withColumn("lid", verdict).filter("NOT lid.rejected").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each class of near duplicates stays, the one with the smallest id."""
    prepared(spark)
    return keep_one(docs.select(*COLUMNS))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: words in repeated windows go; a text that loses some is its kept words, joined by one space.

    Documents stay, also where nothing is left of their text.
    """
    prepared(spark)
    out = remove_repeats(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: each document as many times as the mix takes it."""
    prepared(spark)
    return mixed_rows(docs.select(*COLUMNS)).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token ids of every text."""
    prepared(spark)
    out = encode(docs.select("doc_id", "source", "text"))
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("mixing", mixing),
    ("encoding", encoding),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; the last one's rows."""
    docs = open_table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
