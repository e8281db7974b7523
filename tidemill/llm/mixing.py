"""Operator 9. Mixing sources to target weights by hash-threshold histograms.

Every document has a size (words) and a 60-bit hash of its id and text. A
source's target is a whole number of passes over the source plus a rest; the
rest is met by the documents whose hash lies at or below a threshold. The
threshold is found without sorting documents: sizes are summed by (source,
hash bucket), the bucket in which the running total crosses the rest is the
boundary, and only that bucket's documents enter the next, finer histogram.
Rows equal in id and text share that hash; where they are the boundary, a
second hash, of the whole row, is refined in the same way. What it cannot tell
apart are equal rows, and as many of them are taken as the rest asks for.

Defined cases: null text has size 0; null sources form one source, last in
order; of rows equal in every column any may stand for the others; an empty
table gives an empty result; a source of size 0 has target 0; other columns
of the input are kept by ``mixed_rows`` and read for the second hash only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import open_table, stored, words_of

WEIGHTS = (3, 1, 2)  # repeating over the sources in code-point order
SHARE = 1.5  # of all sizes
MAX_PASSES = 2
HASH_BITS, STEP_BITS = 60, 12
#: Copies of one row that a task writes out before others take over.
REPEATS_A_TASK = 10_000
#: Sources planned on the driver; one row each. More than this is an error, never a cut.
MAX_SOURCES = 1_000_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE, passes: float = MAX_PASSES) -> list[float]:
    """Share out ``share * sum(sizes)`` by weight; a source stops at ``passes`` times its size, the rest is reshared."""
    out, budget, active = [0.0] * len(sizes), share * sum(sizes), list(range(len(sizes)))
    while active:
        total = sum(weights[i] for i in active)
        over = [i for i in active if budget * weights[i] / total > passes * sizes[i]]
        if not over:
            for i in active:
                out[i] = budget * weights[i] / total
            break
        for i in over:
            out[i] = float(passes * sizes[i])
        budget -= sum(out[i] for i in over)
        active = [i for i in active if i not in set(over)]
    return out


def _hash(doc_id: str, text: str):
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _row_hash(docs: DataFrame) -> Column:
    """Hash of all columns; nulls are marked, since the hash function passes over them."""
    cols = [(F.col(f"`{c}`"), t) for c, t in docs.dtypes]
    flat = [F.to_json(F.struct(c)) if "map<" in t or "variant" in t else c for c, t in cols]
    return F.xxhash64(*flat, F.array(*[c.isNull() for c, _ in cols])).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(m_key, m_thr, m_row_thr, m_extra, m_group) for each source with a rest.

    Rows with (m_hash, m_row) below the threshold make up the rest together
    with ``m_extra`` of the ``m_group`` equal rows on it.
    """
    open_ = plan.filter("m_rest > 0").select("m_key", "m_rest", F.lit(0).cast("long").alias("m_thr"), F.lit(0).cast("long").alias("m_row_thr"))
    done = None
    for column, low in (("m_hash", "m_thr"), ("m_row", "m_row_thr")):
        for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
            inside = sized.join(F.broadcast(open_), "m_key")  # at most MAX_SOURCES narrow rows
            if column == "m_row":
                inside = inside.filter("m_hash = m_thr")
            if shift < HASH_BITS - STEP_BITS:  # only the boundary bucket of the level above
                inside = inside.filter(F.shiftright(column, shift + STEP_BITS) == F.shiftright(low, shift + STEP_BITS))
            hist = inside.groupBy("m_key", "m_rest", F.shiftright(column, shift).alias("m_bucket")).agg(
                F.sum("m_size").alias("m_sum"),
                F.count("*").alias("m_group"),
                F.min("m_hash").alias("m_thr"),
                F.max("m_hash").alias("m_top"),
                F.min("m_row").alias("m_row_thr"),
                F.max("m_row").alias("m_row_top"),
            )
            upto = Window.partitionBy("m_key").orderBy("m_bucket")  # at most 2**STEP_BITS rows a source
            cum = hist.withColumn("m_cum", F.sum("m_sum").over(upto))
            edge = cum.filter("m_cum >= m_rest AND m_cum - m_sum < m_rest").withColumn("m_rest", F.expr("m_rest - (m_cum - m_sum)"))
            edge = stored(edge.withColumn("m_equal", F.expr("m_thr = m_top AND m_row_thr = m_row_top")), "mix-edge")
            # Equal rows left in the boundary bucket: the number of them that comes nearest to the rest.
            ready = (
                edge.filter("m_equal")
                .withColumn("m_each", F.expr("m_sum div m_group"))
                .withColumn("m_extra", F.expr("CAST(floor(m_rest / m_each) AS LONG)"))
                .withColumn("m_left", F.expr("m_rest - m_extra * m_each"))
                .withColumn("m_extra", F.expr("m_extra + CASE WHEN m_each - m_left <= m_left THEN 1 ELSE 0 END"))
                .select("m_key", "m_thr", "m_row_thr", "m_extra", "m_group")
            )
            done = ready if done is None else done.union(ready)
            open_ = edge.filter("NOT m_equal").select("m_key", "m_rest", "m_thr", "m_row_thr")
            if open_.isEmpty():
                return done
    return done


def _keys(docs: DataFrame, source: str, doc_id: str, text: str) -> tuple:
    """(m_key, m_hash, m_row): a key that tells a null source from any text, in code-point order with null last; the row's hashes."""
    key = F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), F.col(source).cast("string")))
    return key.alias("m_key"), _hash(doc_id, text).alias("m_hash"), _row_hash(docs).alias("m_row")


def plan_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = MAX_PASSES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized rows, plan a source, threshold a source)."""
    spark = docs.sparkSession
    sized = docs.select(F.col(doc_id).alias("m_id"), F.size(words_of(text)).cast("long").alias("m_size"), *_keys(docs, source, doc_id, text))
    sized = stored(sized, "mix-sizes")  # the whole texts are read once; every later step reads these narrow rows
    rows = sized.groupBy("m_key").agg(F.sum("m_size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted((r["m_key"], r["n"]) for r in rows)
    sizes = [n for _, n in rows]
    want = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share, passes)
    plan_rows = []
    for (k, n), t in zip(rows, want, strict=True):
        whole = min(passes, int(t // n)) if n else 0
        plan_rows.append((k, n, t, whole, max(0.0, t - whole * n)))
    plan = spark.createDataFrame(plan_rows, "m_key string, m_source_size long, m_target double, m_whole int, m_rest double")
    return sized, plan, _thresholds(sized, plan)


def _copies() -> Column:
    """How often a row is taken, but for groups of equal rows that the threshold splits: those get their whole passes only."""
    on = "m_hash = m_thr AND (m_row < m_row_thr OR (m_row = m_row_thr AND m_extra = m_group))"
    return F.expr(f"m_whole + CASE WHEN m_hash < m_thr OR ({on}) THEN 1 ELSE 0 END")


def _split_groups(thr: DataFrame) -> DataFrame | None:
    """Thresholds that split a group of equal rows; at most one row a source, None if there is no such group."""
    split = thr.filter("m_extra > 0 AND m_extra < m_group")
    return None if split.isEmpty() else split


def _repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as ``times`` says, written out by many tasks."""
    cut = rows.withColumn("m_part", F.explode(F.expr(f"sequence(0, ({times} - 1) div {REPEATS_A_TASK})")))
    cut = cut.repartition("m_key", "m_part").withColumn("m_turns", F.expr(f"CAST(least({REPEATS_A_TASK}, {times} - m_part * {REPEATS_A_TASK}) AS INT)"))
    return cut.withColumn("m_turn", F.explode(F.expr("array_repeat(0, m_turns)")))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """One row per document: id, m_size, m_source_size, m_target and m_copies (times the mix takes the document)."""
    sized, plan, thr = plan_mix(docs, doc_id, text, source, **how)
    wanted = ("m_id", "m_size", "m_source_size", "m_target", "m_copies")
    out = sized.join(F.broadcast(plan.join(thr, "m_key", "left")), "m_key").withColumn("m_copies", _copies())  # at most MAX_SOURCES narrow rows
    if _split_groups(thr) is None:
        return out.select(*wanted)
    split = F.expr("coalesce(m_hash = m_thr AND m_row = m_row_thr AND m_extra > 0 AND m_extra < m_group, false)")
    # A split group is one row and two numbers: so many of its rows are taken once more, so many not.
    group = out.filter(split).groupBy("m_key").agg(*[F.first(c).alias(c) for c in (*wanted, "m_extra", "m_group")])
    two = group.withColumn("m_two", F.explode(F.expr("array(struct(1 AS more, m_extra AS n), struct(0 AS more, m_group - m_extra AS n))")))
    two = two.withColumn("m_copies", F.expr("m_copies + m_two.more")).withColumn("m_n", F.col("m_two.n"))
    return out.filter(~split).select(*wanted).union(_repeated(two, "m_n").select(*wanted))


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """``docs`` with each row as often as the mix takes it. Texts are not shuffled: a row meets its source's one plan row."""
    _, plan, thr = plan_mix(docs, doc_id, text, source, **how)
    short = F.broadcast(plan.join(thr, "m_key", "left").drop("m_source_size", "m_target", "m_rest"))  # at most MAX_SOURCES narrow rows
    keyed = docs.select(F.struct("*").alias("m_doc"), *_keys(docs, source, doc_id, text))
    taken = keyed.join(short, "m_key").select("m_doc", F.explode(F.array_repeat(F.lit(0), _copies())).alias("m_turn")).select("m_doc.*")
    split = _split_groups(thr)
    if split is None:
        return taken
    # Of a split group one row stands for all; it is read again and written out as often as the rest asks for.
    on = keyed.join(F.broadcast(split), "m_key").filter("m_hash = m_thr AND m_row = m_row_thr")  # at most one short row a source
    more = on.groupBy("m_key").agg(F.first("m_doc").alias("m_doc"), F.first("m_extra").alias("m_extra"))
    return taken.union(_repeated(more, "m_extra").select("m_doc.*"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: size, source_size, target and the words the mix takes."""
    mixed = mix_sources(open_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select(
        F.col("m_id").alias("doc_id"),
        F.col("m_size").alias("size"),
        F.col("m_source_size").alias("source_size"),
        F.col("m_target").alias("target"),
        (F.col("m_size") * F.col("m_copies")).alias("taken"),
    )
