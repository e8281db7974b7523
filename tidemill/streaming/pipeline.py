"""Structured Streaming jobs.

Each job wires a shared DataFrame transform between a topic source and a
sink, with one checkpoint directory per query (never shared). Jobs are
started with a trigger (``availableNow`` by default: process what is there,
then stop; ``processingTime`` for a long-running deployment) and return the
started queries; ``run`` waits for them and surfaces failures.
"""

from __future__ import annotations

import time
from collections import defaultdict
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemill.operators.clean import judge_document, position_of
from tidemill.operators.etl import etl_transform
from tidemill.operators.report import (
    WATERMARK_DELAY,
    daily_by_city,
    daily_by_province,
    daily_sets,
    daily_total,
    report_input,
    sets_to_cells,
)
from tidemill.operators.stores import documents, wide_rows, writable_cells
from tidemill.sources.topics import read_topic
from tidemill.streaming.keyed import BUCKETS, CELL_BUCKETS, KeyedTable


@dataclass
class Trigger:
    """``available_now`` (default) or a ``processing_time`` interval such as '5 seconds'."""

    processing_time: str | None = None

    def apply(self, writer):
        if self.processing_time:
            return writer.trigger(processingTime=self.processing_time)
        return writer.trigger(availableNow=True)


AVAILABLE_NOW = Trigger()


def run(queries: list[StreamingQuery]) -> list[StreamingQuery]:
    """Wait for every query to finish; raise the first failure."""
    for q in queries:
        q.awaitTermination()
    for q in queries:
        err = q.exception()
        if err is not None:
            raise RuntimeError(f"streaming query {q.name} failed: {err}")
    return queries


@dataclass
class Topics:
    """How topics are read: a file format or ``kafka``, its options, and the intake cap per micro-batch."""

    fmt: str = "parquet"
    options: dict | None = None
    max_per_trigger: int | None = None

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return read_topic(spark, topic, True, self.fmt, self.max_per_trigger, self.options)


FILES = Topics()


class LateRows(StreamingQueryListener):
    """T5: adds up, batch by batch, the rows each run dropped as too late."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = defaultdict(int)
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.runId)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def watch_late_rows(spark: SparkSession) -> LateRows:
    """Start counting late rows; call before the queries start, and ``spark.streams.removeListener`` when done."""
    listener = LateRows()
    spark.streams.addListener(listener)
    return listener


def dropped_by_watermark(watch: LateRows, query: StreamingQuery, wait_s: float = 30.0) -> int:
    """T5: rows the ended query's stateful operators dropped as too late, over all batches of its run."""
    until = time.monotonic() + wait_s
    while str(query.runId) not in watch.ended:  # progress reports arrive on a bus of their own, the end after them
        if time.monotonic() > until:
            raise TimeoutError("the query's last progress report has not arrived")
        time.sleep(0.05)
    return watch.dropped[str(query.runId)]


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Queries started inside take these settings with them; the session has its own back afterwards."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Partitions of a report's state by default: it holds a row a day and province (or city), a few thousand a year.
STATE_PARTITIONS = 8


def report_state(spark: SparkSession, partitions: int = STATE_PARTITIONS):
    """Report queries started inside keep their state in at most so many partitions.

    A batch opens, writes and commits every partition of the state, also an
    empty one. The session's shuffle partitions follow the orders, the
    reports' state does not: orders are added up before they are shuffled. A
    query notes the number in its checkpoint with its first batch; a restart
    finds it there.
    """
    key = "spark.sql.shuffle.partitions"
    return settings(spark, {key: str(min(partitions, int(spark.conf.get(key))))})


# ---------------------------------------------------------------- hop 1: ETL
def start_etl(
    spark: SparkSession,
    source_topic: str,
    etl_topic: str,
    checkpoint: str,
    ip_dim: DataFrame,
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    strategy: str = "auto",
    sink_fmt: str = "parquet",
    sink_options: dict | None = None,
) -> StreamingQuery:
    """Raw order topic -> enriched topic, append mode, checkpointed.

    A Kafka sink takes key and value, and numbers the messages itself.
    """
    out = etl_transform(topics.read(spark, source_topic), ip_dim, strategy)
    options = dict(sink_options or {})
    if sink_fmt == "kafka":
        out = out.drop("position")
        options.setdefault("topic", etl_topic)
    else:
        options.setdefault("path", etl_topic)
    writer = out.writeStream.outputMode("append").format(sink_fmt).options(**options).option("checkpointLocation", checkpoint)
    return trigger.apply(writer).start()


# ---------------------------------------------------------------- hop 2: reports
REPORTS = ("total", "province", "city")


def report_tables(spark: SparkSession, store: str, buckets: int = CELL_BUCKETS) -> dict[str, KeyedTable]:
    """The hash-cell tables the three report queries maintain (K2: replace on (key, field)); a hash lies in one bucket."""
    return {
        name: KeyedTable(
            spark, f"{store}/{name}", ["key", "field"], prepare=writable_cells, buckets=buckets, bucket_by=["key"]
        )
        for name in REPORTS
    }


def start_reports(
    spark: SparkSession,
    etl_topic: str,
    store: str,
    checkpoint_root: str,
    cities: list[str],
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    which: tuple[str, ...] = REPORTS,
    query_suffix: str = "",
    buckets: int = CELL_BUCKETS,
    partitions: int = STATE_PARTITIONS,
) -> list[StreamingQuery]:
    """Three update-mode aggregates over one parsed stream, each with its own checkpoint.

    Each micro-batch's changed cells (running totals) are upserted into the
    report's keyed table by ``foreachBatch``.
    """
    orders = report_input(topics.read(spark, etl_topic))
    build = {
        "total": lambda: daily_total(orders, WATERMARK_DELAY),
        "province": lambda: daily_by_province(orders, WATERMARK_DELAY),
        "city": lambda: daily_by_city(orders, cities, WATERMARK_DELAY),
    }
    tables = report_tables(spark, store, buckets)
    started = []
    for name in which:
        writer = (
            build[name]()
            .writeStream.outputMode("update")
            .queryName(f"query-amt-{name}{query_suffix}")
            .option("checkpointLocation", f"{checkpoint_root}/amt-{name}")
            .foreachBatch(tables[name].apply_batch)
        )
        with report_state(spark, partitions):
            started.append(trigger.apply(writer).start())
    return started


def cell_table(spark: SparkSession, store: str, buckets: int = CELL_BUCKETS) -> KeyedTable:
    """All report cells in one keyed table (grain, key, field, value); keys carry the report prefix."""
    return KeyedTable(spark, store, ["key", "field"], prepare=writable_cells, buckets=buckets, bucket_by=["key"])


def start_reports_one_pass(
    spark: SparkSession,
    etl_topic: str,
    store: str,
    checkpoint: str,
    cities: list[str],
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    buckets: int = CELL_BUCKETS,
    partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """A4 as a stream: the three reports in one GROUPING SETS aggregation.

    One read of the topic and one state store instead of three; every
    micro-batch updates the total, province and city cells of the same input
    together, so a reader never sees them at different versions (D11).
    """
    orders = report_input(topics.read(spark, etl_topic))
    cells = sets_to_cells(daily_sets(orders.withWatermark("order_timestamp", WATERMARK_DELAY), cities))
    writer = (
        cells.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(cell_table(spark, store, buckets).apply_batch)
    )
    with report_state(spark, partitions):
        return trigger.apply(writer).start()


# ---------------------------------------------------------------- stores (S3, K3, K4)
def wide_row_table(spark: SparkSession, store: str, buckets: int = BUCKETS) -> KeyedTable:
    """K4: row key -> cells; a later put (by write order) of the same key overwrites the whole row."""
    return KeyedTable(spark, store, ["row_key"], order=["position"], mode="replace", buckets=buckets)


def start_wide_rows(
    spark: SparkSession,
    etl_topic: str,
    store: str,
    checkpoint: str,
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    columns: list[str] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Enriched topic -> wide rows of the listed columns (P10), upserted per micro-batch (every 5 s in the reference)."""
    rows = wide_rows(topics.read(spark, etl_topic), columns)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        wide_row_table(spark, store, buckets).apply_batch
    )
    return trigger.apply(writer).start()


def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, checkpointed as changes, so that it may outgrow memory.

    A query notes the provider in its checkpoint with its first batch; a restart finds it there.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    return settings(spark, wanted)


def latest_by_state(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """U1 as a stateful stream: per key the row of the last write, emitted (update mode) whenever it changes.

    State holds one row a key. The write order decides, not the batch, so
    rows may arrive in any order; rows of equal order go by the rest of the row.
    """
    payload = [c for c in rows.columns if c not in keys and c not in order]
    last = F.max(F.struct(*order, *payload)).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, *[F.col(f"last.{c}").alias(c) for c in payload])


def wide_state_table(spark: SparkSession, store: str, buckets: int = BUCKETS) -> KeyedTable:
    """Wide rows as the stateful stream emits them: each replaces its row, no write order left to compare."""
    return KeyedTable(spark, store, ["row_key"], buckets=buckets)


def start_wide_rows_state(
    spark: SparkSession,
    etl_topic: str,
    store: str,
    checkpoint: str,
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    columns: list[str] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Enriched topic -> wide rows, the latest of each key kept as streaming state (RocksDB)."""
    rows = latest_by_state(wide_rows(topics.read(spark, etl_topic), columns), ["row_key"], ["position"])
    writer = (
        rows.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(wide_state_table(spark, store, buckets).apply_batch)
    )
    with rocksdb_state(spark):
        return trigger.apply(writer).start()


def document_table(spark: SparkSession, store: str, buckets: int = BUCKETS) -> KeyedTable:
    """K3: documents keyed by order id; fields merge in write order (a NULL never overwrites)."""
    return KeyedTable(spark, store, ["orderId"], order=["position"], mode="merge", buckets=buckets)


def start_documents(
    spark: SparkSession,
    etl_topic: str,
    store: str,
    checkpoint: str,
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    buckets: int = BUCKETS,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Enriched topic -> documents merged on the order id.

    With ``quarantine``, messages that are no documents are kept there (W5).
    """
    messages, table = topics.read(spark, etl_topic), document_table(spark, store, buckets)
    if quarantine:
        rows, apply = judge_document(messages, position_of(messages)), Quarantine(table, quarantine)
    else:
        rows, apply = documents(messages), table.apply_batch
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return trigger.apply(writer).start()


class Quarantine:
    """What a micro-batch holds is parsed and judged once; documents go to the table, the rest to a folder.

    ``<path>/rejected`` holds each rejected message's text, position, batch id
    and reason, ``<path>/counts`` a row a batch: messages read, kept and
    rejected, counted by observed metrics while the batch is written. A
    replayed batch replaces its own rows in both.
    """

    def __init__(self, table: KeyedTable, path: str):
        self.table, self.path = table, path

    def _put(self, rows: DataFrame, name: str, batch_id: int) -> None:
        writer = rows.withColumn("batch", F.lit(int(batch_id))).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.path}/{name}")

    def __call__(self, judged: DataFrame, batch_id: int) -> None:
        seen, judged = Observation(), judged.persist()
        # Counted by the write that reads all of them.
        counted = judged.observe(
            seen,
            F.count(F.lit(1)).alias("read"),
            F.count_if(F.col("reason").isNull()).alias("kept"),
            F.count("reason").alias("rejected"),
        )
        try:
            self._put(counted.filter("reason IS NOT NULL").select("position", "value", "reason"), "rejected", batch_id)
            self.table.apply_batch(judged.filter("reason IS NULL").drop("value", "reason"), batch_id)
            n = seen.get
            if n["read"]:
                row = judged.sparkSession.createDataFrame([(n["read"], n["kept"], n["rejected"])], "read long, kept long, rejected long")
                self._put(row.coalesce(1), "counts", batch_id)
        finally:
            judged.unpersist()

    def counts(self) -> DataFrame:
        """(batch, read, kept, rejected) of every batch with messages."""
        return self.table.spark.read.parquet(f"{self.path}/counts").select("batch", "read", "kept", "rejected")

    def rejected(self) -> DataFrame:
        """(batch, position, value, reason) of every message that is no document."""
        return self.table.spark.read.schema(_REJECTED).parquet(f"{self.path}/rejected").select("batch", "position", "value", "reason")


_REJECTED = "position long, value string, reason string, batch int"


# ---------------------------------------------------------------- one read, several stores
def store_tables(spark: SparkSession, store: str, buckets: int = BUCKETS) -> dict[str, KeyedTable]:
    """Cells, documents and wide rows of one stream. The cells add up each batch's own sums."""

    def sums(cells: DataFrame) -> DataFrame:
        return writable_cells(cells).select("key", "field", F.col("value").cast("decimal(20,2)").alias("value"))

    cells = KeyedTable(spark, f"{store}/cells", ["key", "field"], mode="add", prepare=sums, buckets=CELL_BUCKETS, bucket_by=["key"])
    return {
        "cells": cells,
        "documents": document_table(spark, f"{store}/documents", buckets),
        "wide": wide_row_table(spark, f"{store}/wide", buckets),
    }


def start_stores(
    spark: SparkSession,
    etl_topic: str,
    store: str,
    checkpoint: str,
    cities: list[str],
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    buckets: int = BUCKETS,
    tables: dict[str, KeyedTable] | None = None,
) -> StreamingQuery:
    """Enriched topic -> report cells, documents and wide rows: one read, one checkpoint, no state.

    The topic is read once a micro-batch and each store takes its part. The
    stores are not one transaction: a run that ends between two of them
    repeats the batch, and each store then takes what it lacks, bucket by
    bucket, and nothing twice.
    """
    tables = tables or store_tables(spark, store, buckets)

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            tables["cells"].apply_batch(sets_to_cells(daily_sets(report_input(batch), cities)), batch_id)
            tables["documents"].apply_batch(documents(batch), batch_id)
            tables["wide"].apply_batch(wide_rows(batch), batch_id)
        finally:
            batch.unpersist()

    writer = topics.read(spark, etl_topic).writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return trigger.apply(writer).start()


# ---------------------------------------------------------------- state as a table
def state_table(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0) -> DataFrame:
    """The state rows of a query's stateful operator (key, value, partition_id) after a batch; the last one by default."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def last_state_batch(spark: SparkSession, checkpoint: str, operator: int = 0) -> int:
    """Id of the last batch whose state is committed."""
    known = spark.read.format("state-metadata").load(checkpoint).filter(F.col("operatorId") == operator)
    return known.agg(F.max("maxBatchId")).first()[0]


# ---------------------------------------------------------------- bounded daily form (T4, T5)
def late_by_batch(rows: DataFrame, batch: str, event_time: str, delay: str = WATERMARK_DELAY, window: str = "1 day") -> DataFrame:
    """T5: (batch, kept, dropped, untimed), what each micro-batch of a windowed aggregate keeps and drops.

    ``batch`` is the micro-batch's id. Rows are judged by the watermark that
    was in force in the batch before, which knew the batches before that one: a
    running maximum over all ids up to two back, less the delay, one batch of
    grace. (A run that ends for want of input ends with a batch without
    rows, which has an id too.) A row is dropped when its window had ended by
    then; rows without an event time (``untimed``) belong to no window. Times
    count to the millisecond, as the stream tracks them. One pass gathers the
    batches' greatest times (a row a batch, ordered over the ids), a second
    counts.
    """
    at = F.date_trunc("millisecond", F.max(event_time))
    tops = rows.groupBy(F.col(batch).alias("_b")).agg(at.alias("_top"))
    before = Window.orderBy("_b").rangeBetween(Window.unboundedPreceding, -2)  # as many rows as batches
    marks = tops.select("_b", (F.max("_top").over(before) - F.expr(f"INTERVAL {delay}")).alias("_mark"))
    # The window's own columns appear with the expression, so its end is computed on a copy of the time.
    timed = rows.select(F.col(batch).alias("batch"), F.col(event_time).alias("_t"))
    ends = timed.withColumn("_end", F.window_time(F.window("_t", window)) + F.expr("INTERVAL 1 MICROSECOND"))
    untimed = timed.filter("_t IS NULL").withColumn("_end", F.lit(None).cast("timestamp"))
    judged = ends.unionByName(untimed).join(marks, F.col("batch") == F.col("_b"))
    late = F.coalesce(F.col("_end") <= F.col("_mark"), F.lit(False))
    return judged.groupBy("batch").agg(
        F.count_if(F.col("_t").isNotNull() & ~late).alias("kept"),
        F.count_if(F.col("_t").isNotNull() & late).alias("dropped"),
        F.count_if(F.col("_t").isNull()).alias("untimed"),
    )


def bounded_daily_total(orders: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """T4: daily totals on a 1-day event-time window, so the watermark evicts finished days.

    Late rows (older than the previous batch's watermark) are dropped, and
    rows without an event time are excluded, unlike the parity form.
    """
    return (
        orders.withWatermark("order_timestamp", delay)
        .groupBy(F.window("order_timestamp", "1 day").alias("w"))
        .agg(F.sum("money").alias("total_amt"))
        .select(F.col("w.start").cast("date").alias("order_date"), F.col("total_amt"))
    )


def bounded_table(spark: SparkSession, store: str) -> KeyedTable:
    """Daily totals of the bounded form, replaced per day."""
    return KeyedTable(spark, store, ["order_date"], buckets=CELL_BUCKETS)


def start_bounded_daily(
    spark: SparkSession,
    etl_topic: str,
    store: str,
    checkpoint: str,
    topics: Topics = FILES,
    trigger: Trigger = AVAILABLE_NOW,
    partitions: int = STATE_PARTITIONS,
) -> tuple[StreamingQuery, KeyedTable]:
    orders = report_input(topics.read(spark, etl_topic))
    table = bounded_table(spark, store)
    writer = (
        bounded_daily_total(orders)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(table.apply_batch)
    )
    with report_state(spark, partitions):
        return trigger.apply(writer).start(), table
