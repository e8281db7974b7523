"""Operator 12. Hard negatives by the threshold algorithm over per-dimension sorted lists.

Candidates are dealt to blocks; in a block every dimension has its candidates
sorted by that component. An anchor reads each list from the end its own
component's sign asks for (anchor-signed sorted access), scores every
candidate it meets by a random access to the whole vector, and stops once the
threshold, the inner product of the anchor with the components last read, is
strictly below the k-th score of each of its windows (a window not yet full
counts with its own floor). A candidate not met by then scores at most the
threshold, so nothing is lost, ties included.

Two passes share this: positives (the best of the anchor's label; blocks hold
one label, anchors meet their own label's blocks only) and, once an anchor's
positives of all blocks are merged, negatives (other labels, one window below
each positive's score). Blocks are dealt by a hash and bounded in rows, so a
label or a repeated vector with any share of the rows is spread over blocks;
each (candidate block, anchor block) pair is one group, and a group returns
at most ``keep`` rows a window.

Components are 64-bit integers, floor(256 * x). Scores are exact as long as
they fit 64 bits; where the block's largest components prove sums below 2^53,
they are computed in doubles, else in 64-bit integers.

Defined cases: rows with a null label or vector, or with a null or non-finite
component, take no part (a null id does, as a candidate, behind all other
ids on ties); vectors of unlike lengths are compared on the places both have;
an empty vector scores 0 everywhere; an anchor's ``other rows`` are those of
another id, and repeated rows are candidates one by one; rows that repeat an
anchor's id are anchors together, told apart by vector and label, exact copies
counting as one anchor; an anchor without positives, and a window without
rows, return nothing; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import open_table, prepared, stored

#: Candidates and anchors of a block; smaller blocks only to give every core one.
CANDIDATES, ANCHORS = 1 << 16, 1 << 12
LEAST = 2048
KEEP, EVERY, FLIP = 5, 100, 7
LOW, SCALE = 80, 100  # a negative scores at least LOW / SCALE of its positive
FIRST_DEPTH = 16


def participants(rows: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """e_id, e_label, e_vec (64-bit components) of the rows that take part, labels flipped."""
    one = rows.select(F.col(vec_id).alias("e_id"), F.col(embedding).cast("array<double>").alias("x"), F.col(label).cast("long").alias("e_label"))
    sound = F.forall("x", lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    flipped = F.when(F.coalesce(F.col("e_id") % FLIP == 0, F.lit(False)), (F.col("e_label") + 1) % 10).otherwise(F.col("e_label"))
    return one.filter("e_label IS NOT NULL AND x IS NOT NULL").filter(sound).select("e_id", flipped.alias("e_label"), F.transform("x", lambda v: F.floor(256 * v)).alias("e_vec"))


class Lists:
    """A block's candidates with, for each dimension, their order by that component."""

    def __init__(self, vectors: np.ndarray, reach: int):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        largest = int(np.abs(vectors).max(initial=0))
        self.exact = largest * reach < 1 << 53  # reach: the largest sum of an anchor's absolute components
        self.scored = vectors.astype(np.float64) if self.exact else vectors

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.scored[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.scored[rows] @ anchor

    def best(self, anchor: np.ndarray, fits: np.ndarray, rank: np.ndarray, windows: list[tuple[int | None, int | None]], keep: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (floor, ceiling) the ``keep`` first of the candidates that fit: rows and scores.

        Higher scores come first, ties by ``rank``.
        """
        n, used = len(self.vectors), np.flatnonzero(anchor)
        seen, known_rows, known_scores = np.zeros(n, bool), [], []
        depth, read = FIRST_DEPTH, 0
        falling = used[anchor[used] > 0]
        rising = used[anchor[used] < 0]
        while True:
            depth = min(depth, n) if len(used) else n
            met = np.zeros(n, bool)
            met[self.order[n - depth : n - read, falling]] = True
            met[self.order[read:depth, rising]] = True
            if depth == n:
                met[:] = True
            new = np.flatnonzero(met & ~seen & fits)
            seen |= met
            known_rows.append(new)
            known_scores.append(self.scores(new, anchor))
            rows, scores = np.concatenate(known_rows), np.concatenate(known_scores)
            bounded = [np.flatnonzero((scores >= low if low is not None else True) & (scores <= high if high is not None else np.ones(len(scores), bool))) for low, high in windows]
            if depth == n:
                break
            # The components last read bound what every candidate not met yet can score.
            ends = sum(int(anchor[d]) * int(self.vectors[self.order[n - depth, d], d]) for d in falling)
            ends += sum(int(anchor[d]) * int(self.vectors[self.order[depth - 1, d], d]) for d in rising)
            if all(ends < (np.partition(scores[w], len(w) - keep)[len(w) - keep] if len(w) >= keep else low if low is not None else -(1 << 63)) for w, (low, _) in zip(bounded, windows, strict=True)):
                break
            read, depth = depth, depth * 2
        found = []
        for w in bounded:
            w = w[np.lexsort((rank[rows[w]], -scores[w]))][:keep]
            found.append((rows[w], scores[w]))
        return found


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of components, short vectors filled with zeros."""
    sizes = pc.list_value_length(vectors).to_numpy()
    flat = pc.list_flatten(vectors).to_numpy()
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _search(windows_of, keep: int, same_label: bool):
    """The group function: anchors on the left, a block of candidates on the right."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"e_key": [], "window": [], "c_id": [], "score": []}
        names = list(empty)
        schema = pa.schema([("e_key", pa.binary()), ("window", pa.int64()), ("c_id", right.schema.field("e_id").type), ("score", pa.int64())])
        if not len(left) or not len(right):
            return pa.table(empty, schema=schema)
        width = max(pc.max(pc.list_value_length(t.column("e_vec"))).as_py() or 0 for t in (left, right))
        anchors, vectors = _matrix(left.column("e_vec"), width), _matrix(right.column("e_vec"), width)
        lists = Lists(vectors, int(np.abs(anchors).sum(axis=1).max(initial=0)))
        ids = right.column("e_id").combine_chunks()
        rank = np.empty(len(ids), np.int64)
        rank[pc.array_sort_indices(ids, order="ascending").to_numpy()] = np.arange(len(ids))  # nulls last
        labels = right.column("e_label").to_numpy()
        keys, windows, rows, scores = [], [], [], []
        for i, a in enumerate(left.drop_columns(["e_vec"]).to_pylist()):
            other = pc.fill_null(pc.not_equal(ids, pa.scalar(a["e_id"], ids.type)), True).to_numpy(zero_copy_only=False)
            fits = other & (labels == a["e_label"]) if same_label else labels != a["e_label"]
            spans = windows_of(a)
            for w, (r, s) in enumerate(lists.best(anchors[i], fits, rank, [x[1] for x in spans], keep)):
                keys += [a["e_key"]] * len(r)
                windows += [spans[w][0]] * len(r)
                rows.append(r)
                scores.append(s)
        taken = ids.take(pa.array(np.concatenate([np.empty(0, np.int64), *rows])))
        return pa.Table.from_arrays([pa.array(keys, pa.binary()), pa.array(windows, pa.int64()), taken, pa.array(np.concatenate([np.empty(0, np.int64), *scores]), pa.int64())], names=names)

    return run


def _no_window(anchor: dict) -> list:
    return [(0, (None, None))]


def _score_windows(anchor: dict) -> list:
    """A window below each of the anchor's different positive scores: LOW / SCALE of it to the score itself."""
    return [(p, (-(-LOW * p // SCALE), p)) for p in anchor["targets"]]


def _blocks(spark: SparkSession, rows: int, most: int, least: int) -> int:
    return max(1, -(-rows // most), min(spark.sparkContext.defaultParallelism, rows // least))


def _meet(anchors: DataFrame, candidates: DataFrame, by: list[str], a_blocks: int, c_blocks: int, fn, kind: str) -> DataFrame:
    """Each anchor block with each candidate block (of equal ``by`` columns), one group a pair."""
    left = anchors.withColumn("ab", F.pmod(F.xxhash64("e_key"), F.lit(a_blocks))).withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))
    right = candidates.withColumn("cb", F.pmod(F.xxhash64("e_id", "e_vec", "e_copy"), F.lit(c_blocks))).withColumn("ab", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(a_blocks - 1).cast("long"))))
    keys = [*by, "ab", "cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(fn, f"e_key binary, window long, c_id {kind}, score long")


def _first(found: DataFrame, by: list[str], keep: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("c_id"))
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= keep)


def mine(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", keep: int = KEEP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = prepared(rows.sparkSession)
    kind = rows.schema[vec_id].dataType.simpleString()
    # Copies of a row are spread over blocks by a random number, which the written table fixes.
    taking = stored(participants(rows, vec_id, embedding, label).withColumn("e_copy", F.floor(F.rand() * (1 << 30))), "negatives-rows")
    is_anchor = F.coalesce(F.col("e_id") % EVERY == 0, F.lit(False))
    key = F.unhex(F.sha2(F.concat_ws(",", F.col("e_id").cast("string"), F.col("e_label").cast("string"), F.concat_ws(" ", F.col("e_vec").cast("array<string>"))), 256))
    anchors = stored(taking.filter(is_anchor).select("e_id", "e_label", "e_vec").distinct().withColumn("e_key", key), "negatives-anchors")
    n_rows, n_anchors = taking.count(), anchors.count()
    a_blocks, c_blocks = max(1, -(-n_anchors // ANCHORS)), _blocks(spark, n_rows, CANDIDATES, LEAST)

    near = _meet(anchors, taking, ["e_label"], a_blocks, c_blocks, _search(_no_window, keep, True), kind)
    positives = _first(near, ["e_key"], keep, "p_rank").select("e_key", F.col("c_id").alias("p_id"), "p_rank", F.col("score").alias("p_score"))
    positives = stored(positives, "negatives-positives")
    targets = positives.groupBy("e_key").agg(F.sort_array(F.collect_set("p_score")).alias("targets"))  # keep scores at most
    aimed = anchors.join(targets, "e_key")
    far = _meet(aimed, taking, [], a_blocks, c_blocks, _search(_score_windows, keep, False), kind)
    negatives = _first(far, ["e_key", "window"], keep, "rank").select("e_key", F.col("window").alias("p_score"), "rank", F.col("c_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        positives.join(negatives, ["e_key", "p_score"])
        .join(anchors.select("e_key", "e_id"), "e_key")
        .select(F.col("e_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank", "negative_id", F.col("p_score").alias("positive_score"), "negative_score")
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five hard negatives of every anchor and positive among the embeddings."""
    return mine(open_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
