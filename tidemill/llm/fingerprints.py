"""Operator 10. Document fingerprints by order MinHash, in built-in expressions only.

A text's k-mers are its runs of ``SHINGLE`` words, numbered by how often they
occurred before. Their hashes are sorted once, each with its place in the
text. Sample j takes the ``MINIMA`` hashes that follow the j-th of ``SAMPLES``
evenly spaced points of the hash circle (a minimum under a rotated order),
puts them back in text order and hashes the tuple. The fingerprint is the
list of these hashes; the likeness of two texts is the share of samples that
agree, which falls with edits, and with moved text, not only with lost words.

The next document in descending id order comes from one shuffle of the texts
by id ranges; the first row of each range is copied to the range before it.
Ranges follow the ids' quantiles, so gaps in the ids do not crowd a range.

Defined cases: null counts as the empty text; two texts without words have
likeness 1, one of them 0 to any text with words; a text of fewer words than
a shingle is one k-mer; null ids come last; rows with equal ids are ordered
by their text's hash; a single row is its own next document; an empty table
gives an empty result; other columns are not read. Places beyond 2**23 words
lose their order, not their hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import let, open_table, words_of

SHINGLE, SAMPLES, MINIMA = 3, 32, 2
PLACE_BITS = 24
_PLACE, _SIGNATURE = (1 << PLACE_BITS) - 1, (1 << 31) - 1
_POINTS = [-(1 << 63) + j * ((1 << 64) // SAMPLES) for j in range(SAMPLES)]
RANGES_A_PARTITION = 4  # id ranges for each shuffle partition, so that partitions even out


def _hash_of(e: Column) -> Column:
    return e.bitwiseAND(F.lit(~_PLACE))


def _count_below(ordered: Column, bound: Column) -> Column:
    """How many elements of a sorted array lie below ``bound``: binary search."""
    powers = F.transform(F.sequence(F.floor(F.log2(F.size(ordered))).cast("int"), F.lit(0)), lambda b: F.call_function("shiftleft", F.lit(1), b))
    return F.aggregate(powers, F.lit(0), lambda r, p: F.when(F.get(ordered, r + p - 1) < bound, r + p).otherwise(r))


def _numbered(ordered: Column) -> Column:
    """Relabel the second and later occurrences of a hash; ``ordered`` holds hash and place, sorted."""

    def relabel(e: Column, i: Column) -> Column:
        before = _count_below(ordered, _hash_of(e))  # equal hashes stand together, by place
        return F.when(
            _hash_of(F.coalesce(F.get(ordered, i - 1), F.bitwise_not(e))) == _hash_of(e),
            _hash_of(F.xxhash64(_hash_of(e), i - before)).bitwiseOR(e.bitwiseAND(F.lit(_PLACE))),
        ).otherwise(e)

    return F.sort_array(F.transform(ordered, relabel))


def _sample(ordered: Column, point: Column) -> Column:
    def at(first: Column) -> Column:
        n = F.size(ordered)
        # Place in the upper bits, hash in the lower: sorted, they are in text order.
        turned = [
            let(F.get(ordered, (first + k) % n), lambda e: F.shiftleft(e.bitwiseAND(F.lit(_PLACE)), 64 - PLACE_BITS).bitwiseOR(F.shiftrightunsigned(e, PLACE_BITS)))
            for k in range(MINIMA)
        ]
        low = F.lit((1 << (64 - PLACE_BITS)) - 1)
        return let(F.sort_array(F.array(*turned)), lambda t: F.xxhash64(*[F.get(t, k).bitwiseAND(low) for k in range(MINIMA)]).bitwiseAND(F.lit(_SIGNATURE)).cast("int"))

    return let(_count_below(ordered, point), at)


def fingerprint(text: Column) -> Column:
    """Array of ``SAMPLES`` 31-bit signatures; empty for a text without words."""

    def of_words(h: Column) -> Column:
        n = F.size(h)
        runs = F.transform(F.slice(h, 1, F.greatest(n - (SHINGLE - 1), F.lit(1))), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, SHINGLE)]))

        def placed(runs: Column) -> Column:
            put = F.transform(runs, lambda x, i: _hash_of(x).bitwiseOR(F.least(i, F.lit(_PLACE)).cast("long")))
            ordered = F.sort_array(put)
            return F.when(F.size(F.array_distinct(runs)) == F.size(runs), ordered).otherwise(let(ordered, _numbered))

        points = F.array(*[F.lit(p).cast("long") for p in _POINTS])
        drawn = let(let(runs, placed), lambda o: F.transform(points, lambda p: _sample(o, p)))
        return F.when(n > 0, drawn).otherwise(F.array().cast("array<int>"))

    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), of_words)


def likeness(a: Column, b: Column) -> Column:
    """Share of samples that agree; 1 for two empty fingerprints, 0 for one."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False))))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(same / F.lit(float(SAMPLES)))


def as_text(signatures: Column) -> Column:
    """Eight hexadecimal digits a signature."""
    digits = F.transform(signatures, lambda x: F.lower(F.lpad(F.hex(x), 8, "0")))
    return F.array_join(digits, "")


def with_next(rows: DataFrame, order: str, *carried: str) -> DataFrame:
    """``rows`` with struct ``f_next`` of the ``carried`` columns of the next row by ``order`` descending; after the last, the first."""
    spark = rows.sparkSession
    parts = RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    keyed = rows.withColumn("f_id", F.coalesce(F.col(order).cast("long"), F.lit(least))).withColumn("f_h", F.xxhash64(carried[0]))
    cuts = keyed.select(F.percentile_approx("f_id", [i / parts for i in range(1, parts)], 100 * parts).alias("q")).first()["q"]
    bounds = F.lit(",".join(map(str, sorted(set(cuts or [])))))
    bounds = F.split(bounds, ",").cast("array<long>") if cuts else F.array().cast("array<long>")
    number = let(bounds, lambda b: _count_below(b, F.col("f_id"))) if cuts else F.lit(0)
    ranged = keyed.withColumn("f_range", number)
    # One row a range: its first in descending order, which also closes the range before it.
    tops = ranged.groupBy("f_range").agg(F.max(F.struct("f_id", "f_h")).alias("t")).select("f_range", "t.f_id", "t.f_h").collect()
    tops = sorted((r["f_range"], r["f_id"], r["f_h"]) for r in tops)
    closes = [(r, i, h, tops[(k + 1) % len(tops)][0]) for k, (r, i, h) in enumerate(tops)]
    close = spark.createDataFrame(closes, "f_range int, f_id long, f_h long, f_to int")
    both = ranged.join(F.broadcast(close), ["f_range", "f_id", "f_h"], "left")  # at most ``parts`` rows
    spot = lambda r, late: F.struct(r.cast("int").alias("r"), F.lit(late).alias("late"))
    spots = F.when(F.col("f_to").isNull(), F.array(spot(F.col("f_range"), 0))).otherwise(F.array(spot(F.col("f_range"), 0), spot(F.col("f_to"), 1)))
    dealt = both.withColumn("f_spot", F.explode(spots)).withColumn("f_r", F.col("f_spot.r")).withColumn("f_late", F.col("f_spot.late"))
    along = Window.partitionBy("f_r").orderBy("f_late", F.desc("f_id"), F.desc("f_h"))
    out = dealt.withColumn("f_next", F.lead(F.struct(*carried)).over(along)).filter("f_late = 0")
    return out.select(*rows.columns, "f_next")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text, its signatures, the edited text and its signatures, and the next document's signatures of every row."""
    rows = docs.select(F.col(doc_id).alias("f_doc"), F.coalesce(F.col(text), F.lit("")).alias("f_text"))
    rows = rows.withColumn("f_sig", fingerprint(F.col("f_text")))
    found = with_next(rows, "f_doc", "f_text", "f_sig")
    n = F.length("f_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("f_text"), F.lit(1), n - half), F.substring(F.col("f_next.f_text"), F.lit(1), half))
    found = found.withColumn("f_edited", edited).withColumn("f_next_sig", F.col("f_next.f_sig")).drop("f_next")
    return found.withColumn("f_edited_sig", fingerprint(F.col("f_edited")))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    found = fingerprints(open_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        F.col("f_doc").alias("doc_id"),
        F.length("f_text").cast("long").alias("n_chars"),
        F.sha2(F.col("f_edited"), 256).alias("edited_sha256"),
        as_text(F.col("f_sig")).alias("fingerprint"),
        as_text(F.col("f_edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("f_sig"), F.col("f_edited_sig")).alias("near_edited"),
        likeness(F.col("f_sig"), F.col("f_next_sig")).alias("near_next"),
    )
