"""Operator 11. Ranked lexical search by pipelined term partitioning.

The terms of the items are dealt to ``OWNERS`` owners by weight, rare terms
first, each owner holding about the same number of postings. Documents are
dealt to shards of about ``SHARD`` documents. An item's bundle, one for each
shard, travels from owner to owner: at each stage ``cogroup`` brings a
shard's bundles and the owner's postings of that shard together, the owner
adds its integer contributions to the bundle's sparse accumulators, and the
bundle moves on. An accumulator is dropped only where even the largest
contributions of all later owners would leave it strictly below the shard's
present ``top`` best, so the result is exact. The last owner selects each
shard's best documents, and a window selects among the shards'.

Statistics (documents, terms, document counts) cover all documents. A filter
of ``FLAGS`` flags, broadcast, keeps words that no item has out of the
postings; what it lets through by chance falls out in the join with the
items' terms. Nothing else grows with the tables on one machine: items are
dealt to blocks of ``BLOCK``, postings to shards and owners.

Defined cases: a document is a row, so repeated rows rank one by one and
equal scores go by ascending id (null last); documents with null or empty
texts match nothing; items equal in id and text are one item; items without
a term, or whose terms no document holds, return nothing; ids may be of any
type that orders; other columns are not read. Contributions of weight 0 (a
term that all but every document holds) do not make a match.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import open_table, prepared, released, stored

OWNERS, SHARD, BLOCK, FLAGS, TOP = 4, 8192, 1024, 1 << 20, 10
#: Bytes of the items' terms up to which they are broadcast to the postings' tasks; beyond, the join shuffles.
BROADCAST_BYTES = 16 << 20

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(i_key, i_id, term, reps) of every item; the key tells items of one id and different texts apart."""
    one = items.select(F.col(item_id).alias("i_id"), F.col(text).alias("i_text")).distinct()
    terms = F.regexp_extract_all(lower_ascii(F.col("i_text")), F.lit(_TERM), 0)
    keyed = one.select(F.sha2(F.coalesce("i_text", F.lit("")), 256).alias("i_key"), "i_id", F.explode(terms).alias("term"))
    return keyed.groupBy("i_key", "i_id", "term").agg(F.count("*").alias("reps"))


def term_counts(docs: DataFrame, flags: bytes, doc_id: str, text: str) -> DataFrame:
    """One row a document with terms: d_row (unique), d_id, n, and its flagged terms with their counts."""
    rows = docs.select(F.col(doc_id).alias("d_id"), F.col(text).alias("d_text"))
    shared = docs.sparkSession.sparkContext.broadcast(flags)  # FLAGS bytes
    kind = rows.schema["d_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, mask = shared.value, FLAGS - 1
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            keep, ids, sizes, terms, counts, ends = [], [], [], [], [], [0]
            for i, text in enumerate(batch.column(1)):
                words = Counter((text.as_py() or "").encode().translate(_SPACED).split())
                if not words:
                    continue
                keep.append(i)
                sizes.append(words.total())
                for word, tf in words.items():
                    if wanted[zlib.crc32(word) & mask]:
                        terms.append(word)
                        counts.append(tf)
                ends.append(len(terms))
            ids = batch.column(0).take(pa.array(keep, pa.int64()))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(keep)), pa.int64()),
                    ids,
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(at, pa.array(counts, pa.int64())),
                ],
                names=["d_row", "d_id", "n", "terms", "tfs"],
            )
            row += len(keep)

    return rows.mapInArrow(released(run), f"d_row long, d_id {kind}, n long, terms array<string>, tfs array<long>")


def _owner_edges(weights: list[tuple[int, int]]) -> list[int]:
    """Lowest weight of each owner but the last, from (weight, postings) pairs: rare terms first, postings in equal shares."""
    total, edges, run = sum(k for _, k in weights), [], 0
    for weight, k in sorted(weights, reverse=True):
        run += k
        if len(edges) < OWNERS - 1 and run * OWNERS >= total * (len(edges) + 1):
            edges += [weight] * min(OWNERS - 1 - len(edges), run * OWNERS // total - len(edges))
    return edges + [-1] * (OWNERS - 1 - len(edges))


def _stage(stage: int, top: int):
    """The owner's work on one shard's bundles and postings."""

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = np.unique(np.concatenate([right.column("d_row").to_numpy(), pc.list_flatten(left.column("rows")).to_numpy()]))
        listed = right.column("term").combine_chunks()
        codes = pc.fill_null(listed.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        names = {t: i for i, t in enumerate(listed.dictionary_encode().dictionary.to_pylist())}
        order = np.argsort(codes, kind="stable")
        cuts = np.searchsorted(codes[order], np.arange(len(names) + 1))
        place = np.searchsorted(rows, right.column("d_row").to_numpy())[order]
        gain = pc.fill_null(right.column("gain"), 0).to_numpy()[order]
        last = stage == OWNERS - 1
        if last:  # every document of the shard is listed once, without a term
            ids = right.filter(pc.is_null(right.column("term"))).select(["d_row", "d_id"])
            spot = np.searchsorted(rows, ids.column("d_row").to_numpy())
            by_id = np.empty(len(rows), np.int64)
            by_id[spot[pc.sort_indices(ids, sort_keys=[("d_id", "ascending"), ("d_row", "ascending")], null_placement="at_end").to_numpy()]] = np.arange(len(spot))
            listed_at = np.empty(len(rows), np.int64)
            listed_at[spot] = np.arange(len(spot))
        out_rows, out_scores, out_ids = [], [], []
        for b in left.select(["terms", "rest", "rows", "scores"]).to_pylist():
            score = np.zeros(len(rows), np.int64)
            score[np.searchsorted(rows, np.array(b["rows"], np.int64))] = b["scores"]
            for t in b["terms"]:
                code = names.get(t["term"])
                if code is not None:
                    span = slice(cuts[code], cuts[code + 1])
                    score[place[span]] += t["reps"] * gain[span]  # a document holds a term once
            found = np.flatnonzero(score)
            if len(found) > top:
                kth = np.partition(score[found], len(found) - top)[len(found) - top]
                found = found[score[found] + b["rest"][stage] >= kth]
            if last:
                found = found[np.lexsort((by_id[found], -score[found]))][:top]
                out_ids.append(listed_at[found])
            out_rows.append(rows[found])
            out_scores.append(score[found])
        ends = pa.array(np.cumsum([0, *(len(r) for r in out_rows)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *x]), pa.int64())) for x in (out_rows, out_scores)]
        if last:
            taken = ids.column("d_id").combine_chunks().take(pa.array(np.concatenate([np.empty(0, np.int64), *out_ids]), pa.int64()))
            lists.append(pa.ListArray.from_arrays(ends, taken))
            return pa.table([left.column("i_key"), left.column("i_id"), *lists], names=["i_key", "i_id", "rows", "scores", "ids"])
        names_out = [n for n in left.schema.names if n not in ("rows", "scores")]
        return pa.table([*(left.column(n) for n in names_out), *lists], names=[*names_out, "rows", "scores"])

    return add


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP, shard: int = SHARD) -> DataFrame:
    """i_id, i_key, rank, d_id, score: each item's ``top`` best documents."""
    spark = prepared(docs.sparkSession)
    wanted = stored(item_terms(items, item_id, item_text), "rank-items")
    vocabulary = wanted.select("term").distinct()
    flags = bytearray(FLAGS)
    for r in vocabulary.select((F.crc32(F.encode("term", "UTF-8")) % FLAGS).alias("f")).distinct().collect():  # FLAGS numbers at most
        flags[r["f"]] = 1
    counts = stored(term_counts(docs, bytes(flags), doc_id, text), "rank-counts")
    total = counts.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    big_n, big_l = total["docs"], total["words"] or 1

    # Each posting: how much one mention of the term in an item adds to the document.
    m = F.expr(f"25L + ((75L * n * {big_n}L) div {big_l}L)")
    spread = counts.select("d_row", "n", F.inline(F.arrays_zip("terms", "tfs")).alias("term", "tf")).withColumn("m", m)
    shares = spread.select("d_row", "term", F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)").alias("share"))
    stats = shares.groupBy("term").agg(F.count("*").alias("df"), F.max("share").alias("most"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * big_n + 2) / (2.0 * F.col("df") + 1)))
    weighed = stored(vocabulary.join(stats, "term").select("term", "df", "most", weight.alias("w")), "rank-terms")
    edges = _owner_edges([(r["w"], r["k"]) for r in weighed.groupBy("w").agg(F.sum("df").alias("k")).collect()])  # as many weights as logarithms have steps
    owner = F.lit(0)
    for edge in edges:
        owner = owner + F.when(F.col("w") < edge, 1).otherwise(0)
    owned = weighed.withColumn("owner", owner)
    size = owned.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0

    shards = max(1, -(-big_n // shard))
    blocks = max(1, -(-wanted.select("i_key", "i_id").distinct().count() // BLOCK))
    of_shard = F.pmod(F.xxhash64("d_row"), F.lit(shards)).cast("int").alias("shard")
    to_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")

    # Bundles: an item's terms, what later owners can add at most, and its accumulators so far.
    rest = [F.sum(F.when(F.col("owner") > s, F.col("reps") * F.col("w") * F.col("most")).otherwise(0)) for s in range(OWNERS)]
    bundles = (
        wanted.join(owned, "term")
        .groupBy("i_key", "i_id")
        .agg(F.collect_list(F.struct("term", "reps")).alias("terms"), F.array(*rest).alias("rest"))
        .withColumn("block", F.pmod(F.xxhash64("i_key", "i_id"), F.lit(blocks)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .select("shard", "block", "i_key", "i_id", "terms", "rest", F.array().cast("array<long>").alias("rows"), F.array().cast("array<long>").alias("scores"))
    )
    d_kind = counts.schema["d_id"].dataType.simpleString()
    i_kind = wanted.schema["i_id"].dataType.simpleString()
    carried = bundles.schema
    for stage in range(OWNERS):
        mine = owned.filter(F.col("owner") == stage).select("term", "w")
        mine = F.broadcast(mine) if size <= BROADCAST_BYTES else mine
        postings = shares.join(mine, "term").select(of_shard, "d_row", "term", (F.col("w") * F.col("share")).alias("gain"))
        if stage == OWNERS - 1:
            listed = counts.select(of_shard, "d_row", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("gain"), "d_id")
            postings = postings.withColumn("d_id", F.lit(None).cast(d_kind)).unionByName(listed)
        postings = postings.select("*", to_blocks)
        out = carried if stage < OWNERS - 1 else f"i_key string, i_id {i_kind}, rows array<long>, scores array<long>, ids array<{d_kind}>"
        bundles = bundles.groupBy("shard", "block").cogroup(postings.groupBy("shard", "block")).applyInArrow(_stage(stage, top), out)
    best = bundles.select("i_key", "i_id", F.inline(F.arrays_zip("rows", "scores", "ids")).alias("d_row", "score", "d_id"))
    order = Window.partitionBy("i_key", "i_id").orderBy(F.desc("score"), F.asc_nulls_last("d_id"), "d_row")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("i_id", "i_key", "rank", "d_id", "score")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = open_table(spark, sf_dir, "documents", "doc_id", "text")
    found = search(docs, open_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(F.col("i_id").alias("item_id"), "rank", F.col("d_id").alias("doc_id"), "score")
