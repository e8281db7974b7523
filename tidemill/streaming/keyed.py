"""Replay-safe keyed tables maintained from micro-batches (U3, K2-K4, W6): copy on write by key bucket.

A table is plain Parquet partitioned by ``bucket``, a hash of the keys (or of
``bucket_by``, so that what is written together lies together), and ``slot``,
0 or 1. A micro-batch is first reduced to one row a key; then only the
buckets it touches are read, folded with it and written again, by one
dynamic partition overwrite. Every row of a bucket carries the id of the
batch that wrote it (``version``), and every row the id of the batch that wrote it last
(``_since``), by which ``changed_after`` finds what is new.

* A bucket is written into the slot that does not hold its newest version.
  Overwriting never takes away what a reader sees: a failed write leaves the
  newest version whole, and a read that was planned on a version keeps its
  files until the second batch after it that touches the bucket.
* Replaying a batch changes nothing: a bucket whose version is not older than
  the batch is left alone, also when the first attempt had written some of
  its buckets only.
* A read takes one version of every bucket: one file listing and one scan of
  the version column, then a scan that never grows with the number of
  batches. ``read_for`` opens only the buckets of the keys asked for.
* Update-mode aggregates emit running totals, so their rule is *replace* (U1),
  never add; documents merge field by field (U2); a batch's own sums *add*.

The cost of a batch is the size of the buckets it touches. Choose as many
buckets as keep one bucket's rewrite small (it is one task's work), and a
``bucket_by`` that follows the arrival order where the keys do; the number is
kept with the rows, and another one is refused. The columns are those of the
first batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.upsert import latest_by_key, merge_by_key
from tidemill.session import path_exists

#: Buckets by default: of tables that grow with the orders, and of report cells, a few thousand rows a year.
BUCKETS, CELL_BUCKETS = 16, 4
ROWS_PER_FILE = 1_000_000
BUCKET, SLOT, VERSION, COUNT, AGE, SINCE = "_bucket", "_slot", "_version", "_buckets", "_age", "_since"
_OWN = {BUCKET, SLOT, VERSION, COUNT, SINCE}
_PLACE = [T.StructField(BUCKET, T.IntegerType()), T.StructField(SLOT, T.IntegerType())]


@dataclass
class KeyedTable:
    """A keyed table fed by ``apply_batch`` (usable directly as a ``foreachBatch`` function).

    ``mode`` is ``"replace"`` (U1: last row wins), ``"merge"`` (U2: last
    non-NULL value per field wins) or ``"add"`` (the columns of the batch are
    added to the row's; a batch counts once, by the bucket's version). ``order`` orders rows inside one batch;
    across batches the batch id decides. One writer at a time.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    order: list = field(default_factory=list)
    mode: str = "replace"
    prepare: object = None  # optional DataFrame -> DataFrame applied to each batch
    buckets: int = BUCKETS
    bucket_by: list[str] | None = None  # key columns that choose the bucket; all of them by default
    # The writer's own view (bucket -> (slot, version)) after the batch it applied last; batches in a row need no other look.
    _live: dict[int, tuple[int, int]] | None = field(default=None, repr=False)
    _last: int | None = field(default=None, repr=False)

    # ------------------------------------------------------------ write
    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Fold one micro-batch in; an empty one, or one the table already holds, writes nothing."""
        if self.prepare is not None:
            batch = self.prepare(batch)
        spark = batch.sparkSession
        own = {BUCKET: self._bucket_of(), SINCE: F.lit(int(batch_id)).cast("long")}
        fresh = self._fold(batch, self.keys, self.order).withColumns(own).persist()
        try:
            touched = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]  # as many numbers as buckets at most
            if self._live is None or int(batch_id) - self._last not in (0, 1):
                self._live = self.versions(spark, known=True)  # another writer may have come between
            live, self._last = self._live, int(batch_id)
            todo = sorted(b for b in touched if b not in live or live[b][1] < int(batch_id))
            if not todo:
                return
            rows = fresh.filter(F.col(BUCKET).isin(todo)).withColumn(AGE, F.lit(1))
            kept = {b: live[b][0] for b in todo if b in live}
            if kept:
                old = self._scan(spark, kept, T.StructType([*fresh.drop(BUCKET).schema.fields, *_PLACE]))
                rows = old.drop(SLOT).withColumn(AGE, F.lit(0)).unionByName(rows)
            # One shuffle, by bucket: its task folds the bucket and writes it.
            folded = self._fold(rows.repartition(BUCKET), [BUCKET, *self.keys], [AGE], ties=False)  # a row a key and age
            slots = {b: 1 - kept[b] if b in kept else 0 for b in todo}
            second = [b for b, s in slots.items() if s == 1]
            slot = F.when(F.col(BUCKET).isin(second), 1).otherwise(0) if second else F.lit(0)
            out = folded.withColumns({SLOT: slot, VERSION: F.lit(int(batch_id)).cast("long"), COUNT: F.lit(self.buckets)})
            writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", ROWS_PER_FILE)
            writer.partitionBy(BUCKET, SLOT).parquet(self.path)
            live.update({b: (s, int(batch_id)) for b, s in slots.items()})
        except BaseException:
            self._live = None  # look again: some buckets may have been written
            raise
        finally:
            fresh.unpersist()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.apply_batch(batch, batch_id)

    def _bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*(self.bucket_by or self.keys)), F.lit(self.buckets)).cast("int")

    def _fold(self, rows: DataFrame, keys: list[str], order: list, ties: bool = True) -> DataFrame:
        """One row a key by the table's rule, without the columns that order the writes; ``ties``: rows of a key may be equal in them."""
        own = [o for o in order if isinstance(o, str)]
        if self.mode == "add":
            kinds = dict(rows.dtypes)
            added = [c for c in rows.columns if c not in keys and c not in own]
            sums = [(F.max(c) if c == SINCE else F.sum(c).cast(kinds[c])).alias(c) for c in added]
            return rows.groupBy(*keys).agg(*sums)
        if self.mode == "merge":
            return merge_by_key(rows, keys, order, [c for c in rows.columns if c not in keys and c not in own], ties)
        return latest_by_key(rows, keys, order).drop(*own)

    # ------------------------------------------------------------ read
    def versions(self, spark: SparkSession | None = None, known: bool = False) -> dict[int, tuple[int, int]]:
        """bucket -> (slot, id of the batch that wrote it) of the newest version of every bucket.

        ``known`` asks for a table of as many buckets as this one is declared with.
        """
        own = T.StructType([T.StructField(VERSION, T.LongType()), T.StructField(COUNT, T.IntegerType()), *_PLACE])
        if not path_exists(self.spark, self.path):
            return {}
        frame = (spark or self.spark).read.schema(own).parquet(self.path)
        found: dict[int, tuple[int, int]] = {}
        for r in frame.groupBy(BUCKET, SLOT).agg(F.max(VERSION).alias("v"), F.max(COUNT).alias("n")).collect():  # two rows a bucket
            if known and r["n"] != self.buckets:
                raise ValueError(f"{self.path} has {r['n']} buckets, not {self.buckets}")
            if r[BUCKET] not in found or found[r[BUCKET]][1] < r["v"]:
                found[r[BUCKET]] = (r[SLOT], r["v"])
        return found

    def _scan(self, spark: SparkSession, slots: dict[int, int], schema: T.StructType | None = None) -> DataFrame:
        """The named slot of each bucket; no other folder is listed or opened."""
        reader = spark.read.option("basePath", self.path)
        reader = reader.schema(schema) if schema is not None else reader
        return reader.parquet(*[f"{self.path}/{BUCKET}={b}/{SLOT}={s}" for b, s in sorted(slots.items())])

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table's current rows (keys and payload), of all buckets or the named ones; None before the first batch."""
        live = self.versions(known=buckets is not None)
        if not live:
            return None
        wanted = {b: s for b, (s, _) in live.items() if buckets is None or b in buckets}
        if not wanted:
            b, (s, _) = next(iter(live.items()))
            return self._scan(self.spark, {b: s}).drop(*_OWN).limit(0)
        return self._scan(self.spark, wanted).drop(*_OWN)

    def changed_after(self, batch_id: int) -> tuple[DataFrame | None, int]:
        """Rows written by batches after the given one (None: no such batch), and the id of the newest batch seen.

        Only buckets written since are opened.
        """
        live = self.versions()
        newest = max((v for _, v in live.values()), default=batch_id)
        wanted = {b: s for b, (s, v) in live.items() if v > batch_id}
        if not wanted:
            return None, newest
        return self._scan(self.spark, wanted).filter(F.col(SINCE) > batch_id).drop(*_OWN), newest

    def read_for(self, requests: DataFrame) -> DataFrame | None:
        """The current rows of the buckets that ``requests`` (with the columns that choose the bucket) lie in."""
        asked = requests.select(self._bucket_of().alias(BUCKET)).distinct()
        return self.read([r[BUCKET] for r in asked.collect()])  # as many numbers as buckets at most
