"""Operator 1. Quality rules and a hashed n-gram log-likelihood ratio, in built-in expressions only.

The rules count words, symbols, repeated lines and words in repeated windows.
The ratio compares two multinomials over hashed words and word pairs: one of
a trusted target (all rows labelled good), one of the whole
raw corpus. A text's ratio is the sum of its n-grams' log ratios divided by
their number, and a text is kept if it reaches a fixed threshold: the verdict
on a text depends on the two multinomials and the text alone, with no draw.

Both multinomials have ``BUCKETS`` cells, so counting combines in every task
before its one small shuffle, and the weights are one short array. Each text
is scored inside its own row.

Defined cases: null and empty texts have no words and fail the rules; without
trusted rows every ratio is 0 and the rules alone decide; rows that repeat
count each; a null label is not trusted; an empty table gives an empty
result; other columns are not read. Windows and lines are compared as 64-bit
hashes and as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import let, open_table, stored, words_of

SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30  # words at least; per cent of words in repeated windows at most
BUCKETS = 1 << 14
BROADCAST_IDS = 1_000_000  # a longer list of trusted ids is joined by a shuffle
PRIOR = 1.0  # pseudo-count of each bucket
THRESHOLD = -0.08  # nats an n-gram


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _joined(hashes: Column, step: int) -> Column:
    """Each hash with the one ``step`` further on."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + step)))


def repeated_words(pairs: Column, n: Column) -> Column:
    """Words covered by windows of eight that occur twice or more. ``pairs``: hashes of each word with its next."""

    def covered(windows: Column) -> Column:
        def among(ordered: Column) -> Column:
            same = lambda e, i: F.coalesce(e["h"] == F.get(ordered, i)["h"], F.lit(False))
            twice = F.filter(ordered, lambda e, i: same(e, i - 1) | same(e, i + 1))
            return let(
                F.sort_array(F.transform(twice, lambda e: e["p"])),
                lambda at: F.aggregate(
                    F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
                    F.lit(0).cast("long"),
                    lambda a, x: a + x,
                ),
            )

        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(placed, among))

    fours = _joined(pairs, 2)
    eights = let(fours, lambda f: F.transform(F.slice(f, 1, n - (WINDOW - 1)), lambda x, i: F.xxhash64(x, F.get(f, i + 4))))
    return F.when(n <= WINDOW, F.lit(0).cast("long")).otherwise(let(eights, covered))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def buckets_of(text: Column) -> Column:
    """Buckets of a text's words and of its neighbouring word pairs."""
    return let(
        _hashes(words_of(text)),
        lambda h: F.transform(F.concat(h, F.slice(_joined(h, 1), 1, F.greatest(F.size(h) - 1, F.lit(0)))), _bucket),
    )


def log_ratios(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row with the array ``weights``: log target share minus log raw share of each bucket."""
    known = trusted.select(F.col(doc_id).alias("g_id")).filter("g_id IS NOT NULL").distinct()
    good = known.withColumn("g_good", F.lit(1))
    rows = docs.select(F.col(doc_id).alias("g_id"), F.col(text).alias("g_text"))
    flagged = rows.join(F.broadcast(good) if known.count() <= BROADCAST_IDS else good.hint("merge"), "g_id", "left")
    grams = flagged.select("g_good", F.explode(buckets_of(F.col("g_text"))).alias("b"))
    counts = grams.groupBy("b").agg(F.count("*").alias("raw"), F.count("g_good").alias("good"))
    counts = stored(counts, "ngram-counts")  # at most BUCKETS rows
    sums = counts.agg(F.sum("raw"), F.sum("good")).first()
    all_raw, all_good = (x or 0 for x in sums)
    share = lambda c, n: F.log((F.coalesce(F.col(c), F.lit(0)) + PRIOR) / (n + PRIOR * BUCKETS))
    weight = share("good", all_good) - share("raw", all_raw) if all_good else F.lit(0.0)
    cells = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left").select("b", weight.alias("w"))
    return cells.agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "w"))), lambda e: e["w"]).alias("weights"))


def judge(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, the rules' counts, base_failed, ratio (nats an n-gram) and kept of every row."""

    def measured(words: Column) -> Column:
        def with_hashes(h: Column) -> Column:
            def with_pairs(p: Column) -> Column:
                n = F.size(h)
                sums = lambda a, w: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.get(w, _bucket(x)))
                total = lambda w: sums(h, w) + sums(F.slice(p, 1, F.greatest(n - 1, F.lit(0))), w)
                ratio = let(F.col("g_weights"), total) / F.greatest(2 * n - 1, F.lit(1))
                return F.struct(n.cast("long").alias("n"), repeated_words(p, n).alias("rep"), ratio.alias("ratio"))

            return let(_joined(h, 1), with_pairs)

        return let(_hashes(words), with_hashes)

    table = stored(weights.withColumnRenamed("weights", "g_weights"), "ngram-weights")
    rows = docs.select(F.col(doc_id).alias("g_id"), F.col(text).alias("g_text")).withColumn("g_weights", table.scalar())
    text_col = F.col("g_text")
    out = rows.select(
        "g_id",
        let(words_of(text_col), measured).alias("m"),
        F.length(F.translate(F.coalesce(text_col, F.lit("")), SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(F.coalesce(text_col, F.lit(""))) - F.length(F.translate(F.coalesce(text_col, F.lit("")), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(text_col).alias("n_dup_lines"),
    )
    out = out.select("g_id", F.col("m.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("m.rep").alias("n_repeat_words"), F.col("m.ratio").alias("ratio"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= THRESHOLD))


def op1_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and verdict for every document; the target is the documents labelled good."""
    docs = open_table(spark, sf_dir, "documents", "doc_id", "text")
    good = open_table(spark, sf_dir, "labels", "doc_id", "quality").filter("quality = 1")
    return judge(docs, log_ratios(docs, good)).withColumnRenamed("g_id", "doc_id")
