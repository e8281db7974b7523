"""Offset ledger (R1, R2) over a partitioned message log.

A log is ``(topic, partition, offset, ...)`` where ``offset`` counts the
records before this one in its partition. The ledger is
``(topic, partition, from_offset)``: the next offset to read.

Numbering a partition with one ``row_number`` window would put a whole
partition (a third of the log with three partitions) into one task. Here
the id space is cut into chunks: per (partition, chunk) counts are summed
into a chunk base (a small table: partitions x chunks), and each record's
offset is its base plus its rank inside its (partition, chunk) group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.geo import bounded_side
from tidemill.operators.upsert import latest_by_key

# Records per chunk on average: bounds each rank window's group. The base table has
# partitions x chunks rows; it is broadcast below this bound and shuffled above it.
ROWS_PER_CHUNK = 1_000_000
MIN_CHUNKS = 64
BASE_MAX_ROWS = 4_000_000


def _has_rows(bounds) -> bool:
    return bounds is not None and bounds["lo"] is not None


def number_log(records: DataFrame, topic: str, partition: str, order_col: str) -> DataFrame:
    """Add ``topic`` and ``offset`` (0-based, by ``order_col`` within ``partition``).

    ``order_col`` must be an integer id, unique within a partition.
    """
    bounds = records.agg(
        F.min(order_col).alias("lo"),
        F.max(order_col).alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(partition).alias("parts"),
    ).first()
    lo, hi, n, parts = (bounds["lo"], bounds["hi"], bounds["n"], bounds["parts"]) if _has_rows(bounds) else (0, 0, 0, 0)
    chunks = max(MIN_CHUNKS, -(-n // ROWS_PER_CHUNK))
    width = max(1, -(-(hi - lo + 1) // chunks))
    keyed = records.withColumn("_chunk", F.floor((F.col(order_col) - F.lit(lo)) / F.lit(width)))
    counts = keyed.groupBy(partition, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(partition).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(partition, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # The base table has at most parts x chunks rows: a bound known without another pass.
    small = F.broadcast(base) if parts * chunks <= BASE_MAX_ROWS else None
    within = Window.partitionBy(partition, "_chunk").orderBy(order_col)
    # A NULL partition or id numbers like any other value, so the base is matched null-safely.
    side = (small if small is not None else base).select(F.col(partition).alias("_p"), F.col("_chunk").alias("_c"), "_base")
    numbered = keyed.join(side, keyed[partition].eqNullSafe(F.col("_p")) & keyed["_chunk"].eqNullSafe(F.col("_c")), "inner")
    return numbered.select(
        F.lit(topic).alias("topic"),
        *[c for c in records.columns],
        (F.col("_base") + F.row_number().over(within) - 1).alias("offset"),
    )


def commit_offsets(consumed: DataFrame) -> DataFrame:
    """R2 step 1: next offset per partition for the records just processed."""
    return consumed.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("from_offset"))


def save_offsets(ledger: DataFrame, consumed: DataFrame) -> DataFrame:
    """R2: the ledger after committing ``consumed``; a partition's newer offset replaces the old one."""
    updates = commit_offsets(consumed)
    both = ledger.select("topic", "partition", "from_offset").unionByName(updates)
    return latest_by_key(both, ["topic", "partition"], [F.col("from_offset")])


def resume(log: DataFrame, ledger: DataFrame) -> DataFrame:
    """Records at or after each partition's resume point; a partition without one starts at 0."""
    points = bounded_side(ledger.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "from_offset"))
    joined = log.join(points, (log["topic"] == F.col("_t")) & log["partition"].eqNullSafe(F.col("_p")), "left")
    return joined.filter(F.col("offset") >= F.coalesce(F.col("from_offset"), F.lit(0))).select(*log.columns)
