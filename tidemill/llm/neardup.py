"""Operator 5. Near duplicates by order MinHash, verified by banded alignment.

A text's k-mers are its runs of five words, each labelled with how often it
occurred before in the text. A sample takes the ``MINIMA`` k-mers with the
smallest hashes and hashes them in text order, so two texts share a sample
when they share those k-mers in the same order. Texts that share one of
``SAMPLES`` samples are candidates.

The similarity of two texts is s / (n + m - s): n and m are their numbers of
k-mers, s the longest sequence of labelled k-mers that both have in the same
order (the Jaccard similarity of five-word shingles, order kept). The
alignment is restricted to the diagonals that a similarity of ``LIKE`` leaves
open, which loses nothing at that threshold.

Exact copies are folded first. The members of a bucket (equal sample) of up
to ``SMALL`` texts are all compared. In a larger one they are compared with
its most central member, the one whose samples most other texts share: in a
group of edited copies that is the text they come from. In each further round
the next most central member is the hub, for those members whose class is not
its own. Buckets leave as soon as they hold one class. A group of edited copies
so costs a pair or two a member, not all pairs.

When hubs link little more, the members of the buckets that still hold several
classes are joined exactly: each posts its ``n - ceil(LIKE * n) + 1`` first
k-mers in an order that is the same for all texts, rare ones first. Two texts
that are alike share a post, whatever the order is; rare ones first, texts that
share a passage seldom do. All texts of up to ``SHORT`` k-mers are joined so
as well, since samples fail for short texts. Links are closed into classes by
label propagation on tables.

Defined cases: null and empty texts and those without words have no k-mers;
they are copies of each other if their texts are equal (null counts as
empty); a text of one to four words is one k-mer; rows that repeat are copies;
an empty table gives an empty result; other columns are carried untouched.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tidemill.llm.common import kept, open_table, released, stored, text_column, text_slices
from tidemill.llm.wordhash import Hasher, inside, mix, split_words

SHINGLE, LIKE = 5, 0.8
#: Two texts at similarity 0.8 that share s of u k-mers agree in a sample with probability C(s, 5) / C(u, 5): all samples
#: fail once in 7,500 pairs at u = 50, 10,200 at 100, 13,300 at 1,000. Texts that share no more than a passage, a third of their k-mers, seldom meet.
SAMPLES, MINIMA = 24, 5
#: Texts up to here are joined exactly. A text of 41 k-mers or more is the shorter one of any pair that crosses the border.
SHORT = 50
SMALL = 8  # all pairs of a bucket this small are compared; members of a larger one meet its most central members in turn
YIELD = 0.05  # when fewer of the pairs compared with hubs than this are links, posts find what is left
CELLS = 1 << 18  # counters of the order in which k-mers are posted

_C = np.uint64(0x9E3779B97F4A7C15)
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hasher() -> Hasher:
    made = kept(__name__)
    if not made:
        made[11] = Hasher(11)
    return made[11]


def kmers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(labelled k-mer hashes in text order, ends): text i has hashes[ends[i]:ends[i + 1]]."""
    w = split_words(texts)
    words, count = _hasher().words(w), np.diff(w.ends)
    ok = inside(w.ends, SHINGLE)
    at, hashes = np.flatnonzero(ok), _hasher().windows(words, SHINGLE)[ok]
    for few in range(1, SHINGLE):  # a short text is one k-mer
        start = w.ends[:-1][count == few]
        if len(start):
            at = np.concatenate([at, start])
            hashes = np.concatenate([hashes, mix(_hasher().windows(words, few)[start] ^ mix(np.full(1, few, np.uint64)))])
    order = np.argsort(at, kind="stable")
    hashes, doc = hashes[order], np.searchsorted(w.ends, at[order], side="right") - 1
    size = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    # Occurrence numbers: equal k-mers of one text stand together in a stable sort.
    key = mix(hashes ^ (doc.astype(np.uint64) * _C))
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0]) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    label = np.zeros(len(order), np.uint64)
    label[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return np.where(label > 0, mix(hashes + label * _C), hashes), np.concatenate([[0], np.cumsum(size)])


def samples(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order MinHash: a row per text, a column per sample; rows without k-mers are 0."""
    n = len(ends) - 1
    out = np.zeros((n, SAMPLES), np.int64)
    some = np.flatnonzero(np.diff(ends))
    if not len(some):
        return out
    start, size = ends[:-1][some], np.diff(ends)[some]
    far = len(hashes)
    for j in range(SAMPLES):
        h = mix(hashes ^ mix(np.full(1, j + 1, np.uint64) * _C))
        h[h == _MAX] -= np.uint64(1)
        place, value = np.full((len(some), MINIMA), far, np.int64), np.zeros((len(some), MINIMA), np.uint64)
        for k in range(MINIMA):
            least = np.minimum.reduceat(h, start)
            at = np.flatnonzero((h == np.repeat(least, size)) & (h != _MAX))
            row = np.searchsorted(start, at, side="right") - 1
            row, first = np.unique(row, return_index=True)
            at = at[first]
            place[row, k], value[row, k] = at, hashes[at]
            h[at] = _MAX
        value = np.take_along_axis(value, np.argsort(place, axis=1, kind="stable"), axis=1)
        sig = np.full(len(some), j, np.uint64)
        for k in range(MINIMA):
            sig = mix((sig ^ value[:, k]) + _C)
        out[some, j] = sig.view(np.int64)
    return out


def alignment(a: np.ndarray, b: np.ndarray, like: float = LIKE) -> float:
    """Similarity of two k-mer sequences by banded alignment; 0 where it is certain to lie below ``like``."""
    n, m = len(a), len(b)
    need = like / (1 + like) * (n + m) - 1e-9
    band = max(n, m) - need  # a path further off the diagonal leaves too many k-mers unmatched
    if min(n, m) < need:
        return 0.0
    order = np.argsort(b)
    place = np.searchsorted(b, a, sorter=order)
    place[place == m] = 0
    to = order[place]  # labelled k-mers occur once in a text
    at = np.flatnonzero(b[to] == a)
    to = to[at]
    to = to[np.abs(at - to) <= band]
    if len(to) < need:
        return 0.0
    if (np.diff(to) > 0).all():
        same = len(to)
    else:
        tails: list[int] = []
        for t in to.tolist():
            k = bisect_left(tails, t)
            if k == len(tails):
                tails.append(t)
            else:
                tails[k] = t
        same = len(tails)
    return same / (n + m - same)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = text_column(batch, "n_text")
        for a, b in text_slices(texts):
            part = texts.slice(a, b - a)
            hashes, ends = kmers(part)
            sigs = samples(hashes, ends)
            raw = part.cast(pa.binary()).to_pylist()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sigs.size + 1, SAMPLES), pa.int32()), pa.array(sigs.ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array([hashlib.md5(x).digest() for x in raw], pa.binary()),
                    pa.array(np.diff(ends), pa.int64()),
                    lists,
                    pa.array([packer.compress(x) for x in raw], pa.binary()),
                ],
                names=["n_rest", "n_md5", "n_kmers", "n_sigs", "n_zip"],
            )


def _texts(zipped: list) -> pa.Array:
    back = zstandard.ZstdDecompressor()
    texts = pa.array([back.decompress(z) for z in zipped], pa.binary())
    return pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates' k-mer sequences, 32 bits a k-mer."""
    for batch in batches:
        texts = _texts(batch.column(1).to_pylist())
        for a, b in text_slices(texts):
            hashes, ends = kmers(texts.slice(a, b - a))
            low = hashes.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array([low[x:y].tobytes() for x, y in zip(ends, ends[1:], strict=False)], pa.binary())],
                names=["q_rep", "q_seq"],
            )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, number of k-mers in it) of a task's sequences."""
    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        for x in batch.column(0):
            total += np.bincount(np.frombuffer(x.as_buffer(), np.uint32) & np.uint32(CELLS - 1), minlength=CELLS)
    some = np.flatnonzero(total)
    for a in range(0, len(some), 10_000):
        cell = some[a : a + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell])], names=["cell", "k"])


def posts(hashes: np.ndarray, ends: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, k-mer): each text's first k-mers by their cell's count, as many as leave fewer than ``LIKE`` of it."""
    size = np.diff(ends)
    doc = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((hashes, cells[(hashes & np.uint64(CELLS - 1)).astype(np.int64)], doc))
    place = np.arange(len(order)) - np.repeat(ends[:-1], size)
    first = place < np.repeat(size - np.ceil(LIKE * size - 1e-9).astype(np.int64) + 1, size)
    return doc[first], place[first], hashes[order][first]


def _joined(rest: DataFrame, table: DataFrame, sequences: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``rest`` (rep, comp) that may be alike and are of different classes: every alike pair is among them."""
    spark = rest.sparkSession
    counted = sequences.join(rest.select(F.col("rep").alias("q_rep")), "q_rep", "left_semi").select("q_seq").mapInArrow(released(_counted), "cell int, k long")
    found = counted.groupBy("cell").agg(F.sum("k").alias("k")).toArrow()  # CELLS short rows at most
    cells = np.zeros(CELLS, np.int64)
    cells[found.column("cell").to_numpy()] = found.column("k").to_numpy()
    shared = spark.sparkContext.broadcast(cells)

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(1).to_pylist())
            rep, comp = (batch.column(i).to_numpy() for i in (0, 2))
            for a, b in text_slices(texts):
                hashes, ends = kmers(texts.slice(a, b - a))
                doc, place, post = posts(hashes, ends, shared.value)
                arrays = [rep[a:b][doc], comp[a:b][doc], np.diff(ends)[doc], place, post.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["rep", "comp", "n", "place", "post"])

    texts = table.select(F.col("n_row").alias("rep"), "n_zip").join(rest, "rep").select("rep", "n_zip", "comp")
    all_posts = stored(texts.mapInArrow(released(posted), "rep long, comp long, n long, place long, post long"), "posts")
    # Of a post's classes the largest is not joined with itself, nor a post that one class has to itself.
    kinds = all_posts.groupBy("post", "comp").agg(F.count("*").alias("k")).groupBy("post")
    kinds = kinds.agg(F.max(F.struct("k", "comp")).alias("t"), F.count("*").alias("kinds")).filter("kinds > 1").select("post", F.col("t.comp").alias("top"))
    mixed = stored(all_posts.join(kinds, "post"), "mixed-posts")
    one = stored(mixed.filter("comp <> top").select("post", *[F.col(c).alias(f"a_{c}") for c in ("rep", "comp", "n", "place")]), "other-posts")
    # At a pair's first common post no more k-mers can agree than are left in either.
    need = F.ceil((F.col("n") + F.col("a_n")) * (LIKE / (1 + LIKE)) - 1e-9)
    fits = (F.col("n") - F.col("place") >= need) & (F.col("a_n") - F.col("a_place") >= need)
    once = (F.col("comp") == F.col("top")) | (F.col("a_rep") < F.col("rep"))
    pairs = mixed.join(one, "post").filter((F.col("comp") != F.col("a_comp")) & once & fits)
    return stored(pairs.select(F.least("rep", "a_rep").alias("a"), F.greatest("rep", "a_rep").alias("b")).distinct(), "pairs")


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = (batch.column(i) for i in (2, 3))
        like = [alignment(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)) for x, y in zip(one, two, strict=True)]
        keep = np.array(like) >= LIKE
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of the links (a, b): comp is the smallest node it is connected with."""
    both = stored(links.union(links.select("b", "a")).distinct(), "links")
    found = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        # The smallest label among the neighbours, then that label's own label.
        near = both.join(found.select(F.col("node").alias("b"), F.col("comp").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        step = found.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "c").alias("mid"))
        jump = found.select(F.col("node").alias("mid"), F.col("comp").alias("c"))
        new = step.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("c", "mid")).alias("comp"))
        new = stored(new, "labels")
        found = new.select("node", "comp")
        if new.filter("old <> comp").isEmpty():
            return found


def _merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, comp) after further links between nodes: only classes that the links touch are worked on."""
    if comps is None:
        return components(links)
    name = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp"))
    of = lambda c: F.coalesce(f"{c}_comp", c).alias(c)
    joined = links.join(name("a"), "a", "left").join(name("b"), "b", "left").select(of("a"), of("b"))
    moved = components(joined.union(links.select(F.col("a"), F.col("a").alias("b"))).union(links.select(F.col("b"), F.col("b").alias("a"))))
    old = comps.join(moved.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    fresh = moved.join(comps.select("node"), "node", "left_anti").select("node", "comp")
    return stored(old.union(fresh), "labels")


def _classes(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and (n_md5, comp) for every different text."""
    rest = [f.name for f in docs.schema.fields if f.name != text]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("n_rest") if rest else F.struct(F.lit(0).alias("none")).alias("n_rest"),
        F.col(f"`{text}`").alias("n_text"),
    )
    schema = StructType([rows.schema["n_rest"]])
    for name, kind in (("n_md5", "binary"), ("n_kmers", "long"), ("n_sigs", "array<long>"), ("n_zip", "binary")):
        schema = schema.add(name, DataType.fromDDL(kind))
    table = stored(rows.mapInArrow(released(_sketched), schema).withColumn("n_row", F.monotonically_increasing_id()), "sketches")

    # Copies fold into one representative; a text's samples are the same in each copy.
    reps = table.groupBy("n_md5").agg(F.min("n_row").alias("rep"), F.max_by("n_sigs", "n_row").alias("sigs"), F.max("n_kmers").alias("n"))
    reps = stored(reps, "texts")
    bands = reps.filter("n > 0").select("rep", "n", F.posexplode("sigs").alias("j", "sig"))
    shared = bands.groupBy("j", "sig").agg(F.count("*").alias("k")).filter("k > 1")
    bands = stored(bands.join(shared, ["j", "sig"]), "buckets")
    # How many others share its samples: in a group of edited copies the text they come from has the most.
    central = bands.groupBy("rep").agg(F.sum("k").alias("central"))
    bands = stored(bands.join(central, "rep"), "buckets")
    short = reps.filter(f"n BETWEEN 1 AND {SHORT}").select("rep", F.col("rep").alias("comp"))
    wanted = bands.select("rep").union(short.select("rep")).select(F.col("rep").alias("n_row")).distinct()
    sequences = stored(table.select("n_row", "n_zip").join(wanted, "n_row").mapInArrow(released(_sequences), "q_rep long, q_seq binary"), "sequences")

    def linked(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(sequences.select(F.col("q_rep").alias("b"), F.col("q_seq").alias("two")), "b")
        with_both = with_b.join(sequences.select(F.col("q_rep").alias("a"), F.col("q_seq").alias("one")), "a").select("a", "b", "one", "two")
        return stored(with_both.mapInArrow(released(_aligned), "a long, b long"), "found")

    def classed(members: DataFrame) -> DataFrame:
        if comps is None:
            return members
        named = comps.select(F.col("node").alias("rep"), F.col("comp").alias("now"))
        return members.join(named, "rep", "left").withColumn("comp", F.coalesce("now", "comp")).drop("now")

    comps, turn, rank = None, 0, F.struct("central", "rep")
    here = bands.withColumn("comp", F.col("rep")).withColumn("tried", F.lit(None).cast("struct<central: bigint, rep: bigint>"))
    while True:
        hub = F.max(F.struct("central", "rep", "n", "comp")).alias("h")
        hubs = here.filter(F.col("tried").isNull() | (rank < F.col("tried"))).groupBy("j", "sig").agg(hub).select("j", "sig", "h.*")
        hubs = hubs.select("j", "sig", rank.alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"))
        if turn == 0:  # in a small bucket each member is a hub for those behind it
            few = here.filter(F.col("k") <= SMALL).select("j", "sig", rank.alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"))
            large = here.filter(F.col("k") > SMALL).select("j", "sig").distinct()
            hubs = hubs.join(large, ["j", "sig"], "left_semi").union(few)
        hubs = stored(hubs, "hubs")  # a table of its own: a bucket with many members may be split in the join
        # A member before the hub was a hub itself, so a pair is compared once. Texts of too unlike length are never alike.
        fits = (F.col("comp") != F.col("hub_comp")) & (rank < F.col("hub")) & (F.least("n", "hub_n") >= LIKE * F.greatest("n", "hub_n"))
        pairs = stored(here.join(hubs, ["j", "sig"]).filter(fits).select(F.col("rep").alias("a"), F.col("hub.rep").alias("b")).distinct(), "pairs")
        new = linked(pairs)
        found, compared = new.count(), pairs.count()
        if found:
            comps = _merged(comps, new)
        # The next most central member is the next hub of a large bucket that still holds several classes.
        here = classed(here.filter(F.col("k") > SMALL))
        mixed = here.groupBy("j", "sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("j", "sig")
        last = hubs.select("j", "sig", F.col("hub").alias("tried"))
        here = here.drop("tried").join(mixed, ["j", "sig"])
        if found < YIELD * compared or not compared:
            break
        here = stored(here.join(last, ["j", "sig"]), "members")
        turn += 1
    rest = stored(here.select("rep", "comp").union(classed(short).select("rep", "comp")).distinct(), "rest")
    if not rest.isEmpty():
        new = linked(_joined(rest, table, sequences))
        if not new.isEmpty():
            comps = _merged(comps, new)
    out = reps.select("n_md5", "rep")
    if comps is not None:
        out = out.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("n_md5", F.coalesce("comp", "rep").alias("comp"))
    else:
        out = out.withColumnRenamed("rep", "comp")
    return table, out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, class_id (smallest id of its class), class_size."""
    table, texts = _classes(docs.select(F.col(doc_id).alias("n_id"), F.col(text).alias("n_own")), "n_own")
    ids = table.select(F.col("n_rest.n_id").alias("n_id"), "n_md5")
    per_text = ids.groupBy("n_md5").agg(F.min("n_id").alias("n_first"), F.count("*").alias("k")).join(texts, "n_md5")
    per_text = stored(per_text, "per-text")
    classes = stored(per_text.groupBy("comp").agg(F.min("n_first").alias("class_id"), F.sum("k").alias("class_size")), "classes")
    named = stored(per_text.join(classes, "comp").select("n_md5", "class_id", "class_size"), "named")
    return ids.join(named, "n_md5").select("n_id", "class_id", "class_size")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id (null ids first)."""
    table, texts = _classes(docs, text)
    order = F.struct(F.col(f"n_rest.`{doc_id}`").alias("i"), F.col("n_row").alias("r"))
    first = table.groupBy("n_md5").agg(F.min(order).alias("o")).join(texts, "n_md5").groupBy("comp").agg(F.min("o").alias("o"))
    kept = table.select("n_row", "n_rest", "n_zip").join(stored(first.select(F.col("o.r").alias("n_row")), "kept"), "n_row", "left_semi")

    def unzipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), _texts(batch.column(2).to_pylist())], names=["n_rest", "n_text"])

    back = kept.mapInArrow(released(unzipped), StructType([table.schema["n_rest"]]).add("n_text", "string"))
    return back.select(*[F.col("n_text").alias(text) if c == text else F.col(f"n_rest.`{c}`") for c in docs.columns])


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id and the size of its class of near duplicates."""
    return near_duplicates(open_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("n_id", "doc_id")
