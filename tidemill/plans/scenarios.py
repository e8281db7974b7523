"""Shared building blocks of the registered queries: the pipeline stages over
the supplied tables and the streaming scenarios (topics written from the tables, streams run with availableNow
into fresh folders under the shared checkpoint root).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.casts import to_date_lenient
from tidemill.functions.json import json_field
from tidemill.jobs import store_cells
from tidemill.operators.etl import enriched_orders, etl_output, etl_transform
from tidemill.operators.report import (
    daily_by_city,
    daily_by_province,
    daily_sets,
    daily_total,
    report_input,
)
from tidemill.operators.stores import documents
from tidemill.session import checkpoint_root, prepare_session, scratch_path
from tidemill.sources.fixtures import CITIES, ip_dim, raw_messages
from tidemill.sources.tables import load_table
from tidemill.sources.topics import write_topic
from tidemill.streaming import pipeline as P

MICRO_BATCHES = 3


def start(spark: SparkSession) -> SparkSession:
    """Session settings the queries rely on, and a registered checkpoint folder."""
    prepare_session(spark)
    checkpoint_root(spark)
    return spark


# ---------------------------------------------------------------- batch pipeline stages
def etl_messages(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    """Hop 1 in batch: raw topic -> enriched (key, value) messages."""
    return etl_transform(raw_messages(spark, sf_dir), ip_dim(spark, sf_dir), strategy)


def enriched(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    return enriched_orders(raw_messages(spark, sf_dir), ip_dim(spark, sf_dir), strategy)


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hop 2 input in batch: enriched messages parsed for the reports."""
    return report_input(etl_messages(spark, sf_dir))


def report_cells(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = report_rows(spark, sf_dir)
    if name == "total":
        return daily_total(rows)
    if name == "province":
        return daily_by_province(rows)
    return daily_by_city(rows, CITIES)


def sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sets(report_rows(spark, sf_dir), CITIES)


def kv_tables(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the hash store that the three report streams fill over three arrivals."""
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-etl", "store-kv", "ckpt-report"))
    suffix = "-" + store.rsplit("-", 1)[-1]
    feed(topic, etl_arrivals(spark, sf_dir), lambda: P.run(P.start_reports(spark, topic, store, ckpt, CITIES, query_suffix=suffix)))
    return store


def kv_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of that store."""
    return store_cells(spark, kv_tables(spark, sf_dir), one_pass=False)


def date_spine(rows: DataFrame) -> DataFrame:
    """Every day from the first to the last order date (one row per day)."""
    bounds = rows.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("order_date"))


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three messages an order, in write order: the whole order, then two updates that set some of its fields."""
    docs = documents(etl_messages(spark, sf_dir))
    k, v = F.col("position"), F.col("_v")
    rows = docs.withColumn("_v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    told = rows.select(
        "orderId",
        "userId",
        "orderTime",
        F.when(v != 1, F.col("ip")).alias("ip"),
        F.when(v == 0, F.col("orderMoney")).when((v == 2) & (k % 5 == 0), F.lit("1.5")).alias("orderMoney"),
        v.cast("string").alias("orderStatus"),
        F.when(v == 0, F.col("province")).when((v == 2) & (k % 7 == 0), F.lit("MOVED")).alias("province"),
        F.when(v == 0, F.col("city")).when((v == 1) & (k % 11 == 0), F.lit("MOVED")).alias("city"),
        (k * 3 + v).alias("position"),
    )
    return etl_output(told)


# ---------------------------------------------------------------- streaming scenarios
def chunks(messages: DataFrame, slot, batches: int = MICRO_BATCHES) -> list[DataFrame]:
    """Split messages into ``batches`` arrivals by the number ``slot`` gives each of them.

    The messages are computed once and staged under the shared checkpoint folder,
    partitioned by arrival; each arrival then reads only its own partition.
    """
    spark = messages.sparkSession
    staged = scratch_path(spark, "arrivals")
    slotted = messages.withColumn("_slot", slot.cast("int"))
    slotted.write.partitionBy("_slot").parquet(staged)
    reader = spark.read.schema(slotted.schema)
    return [reader.parquet(staged).filter(F.col("_slot") == i).drop("_slot") for i in range(batches)]


def in_ranges(messages: DataFrame, by: str, batches: int = MICRO_BATCHES):
    """Arrival number by consecutive ranges of ``by``: earlier positions never arrive later."""
    b = messages.agg(F.min(by).alias("lo"), F.max(by).alias("hi")).first()
    lo, hi = (int(b["lo"]), int(b["hi"])) if b["lo"] is not None else (0, 0)
    width = max(1, -(-(hi - lo + 1) // batches))
    return F.floor((F.col(by) - F.lit(lo)) / F.lit(width))


def range_chunks(messages: DataFrame, by: str, batches: int = MICRO_BATCHES) -> list[DataFrame]:
    """Split messages into arrivals by consecutive ranges of ``by``.

    The messages are computed once and staged; the ranges' bounds and the arrivals are read from there.
    """
    spark = messages.sparkSession
    staged = scratch_path(spark, "arrivals")
    messages.write.parquet(staged)
    held = spark.read.schema(messages.schema).parquet(staged)
    slot = in_ranges(held, by, batches)
    return [held.filter(slot == i) for i in range(batches)]


def feed(topic: str, arrivals: list[DataFrame], run_once, only: list[int] | None = None) -> None:
    """Append each arrival to the topic and run the stream once (``availableNow``) before the next.

    Each run restarts the query from its checkpoint and processes exactly the
    arrival just appended as one micro-batch, so micro-batch boundaries do
    not depend on file counts or modification times. Arrivals are written by
    all cores in parallel.
    """
    for i, arrival in enumerate(arrivals):
        if only is not None and i not in only:
            continue
        write_topic(arrival, topic, files=arrival.sparkSession.sparkContext.defaultParallelism)
        run_once()


def raw_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw order topic's messages in three arrivals (dealt by order key)."""
    return chunks(raw_messages(spark, sf_dir), F.pmod("position", F.lit(MICRO_BATCHES)))


def etl_arrivals(spark: SparkSession, sf_dir: str, ordered: bool = False) -> list[DataFrame]:
    """Hop-1 output computed in batch, in three arrivals: dealt by order key, or ``ordered`` by it."""
    msgs = etl_messages(spark, sf_dir)
    return range_chunks(msgs, "position") if ordered else chunks(msgs, F.pmod("position", F.lit(MICRO_BATCHES)))


def version_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """``order_versions`` in three arrivals: some orders' versions come in one, others' over two, always in order."""
    order, version = F.floor(F.col("position") / 3), F.col("position") % 3
    slot = F.least(F.pmod(order, F.lit(MICRO_BATCHES)) + F.when(version == 2, 1).otherwise(0), F.lit(MICRO_BATCHES - 1))
    return chunks(order_versions(spark, sf_dir), slot)


# Every so many purchases, one is told days after it happened.
LATE_EVERY, LATE_DAYS = 89, 5


def event_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Purchase events as enriched order messages, in three arrivals by event id, some of them days late."""
    events = load_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    late = F.when(F.col("event_id") % LATE_EVERY == 0, F.col("ts") - F.expr(f"INTERVAL {LATE_DAYS} DAY")).otherwise(F.col("ts"))
    msgs = events.select(
        F.col("event_id").alias("position"),
        F.col("event_id").cast("string").alias("key"),
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("orderId"),
                F.col("user_id").cast("string").alias("userId"),
                F.date_format(late, "yyyy-MM-dd HH:mm:ss.SSS").alias("orderTime"),
                F.col("value").cast("decimal(10,2)").cast("string").alias("orderMoney"),
                F.lit(0).alias("orderStatus"),
            )
        ).alias("value"),
    )
    return range_chunks(msgs, "position")


def event_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase messages of ``event_arrivals`` parsed for the reports, with the id of their micro-batch.

    A run over an arrival makes two batches, the second without rows.
    """
    out = None
    for i, arrival in enumerate(event_arrivals(spark, sf_dir)):
        rows = report_input(arrival).withColumn("batch", F.lit(2 * i))
        out = rows if out is None else out.unionByName(rows)
    return out


class LostOnce:
    """A store that the stream loses once, before the given micro-batch reaches it."""

    def __init__(self, table, batch_id: int):
        self.table, self.batch_id, self.lost = table, batch_id, False

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id == self.batch_id and not self.lost:
            self.lost = True
            raise ConnectionError("the store is gone")
        self.table.apply_batch(batch, batch_id)


def cells_of(rows: DataFrame, store: str, key: str, fields: list[str]) -> DataFrame:
    """Rows spelled out as (store, key, field, value), a row for each field."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    return rows.select(F.lit(store).alias("store"), F.col(key).alias("key"), pairs.alias("p")).select("store", "key", "p.field", "p.value")


def day_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Hop-1 output in three arrivals by the orders' days: each tells of days of its own."""
    msgs = etl_messages(spark, sf_dir).withColumn("day", F.unix_date(to_date_lenient(json_field("value", "orderTime"))))
    return range_chunks(msgs, "day")


def damaged_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw topic with its junk lines and, at fixed positions, texts cut short, lists, and records without their id."""
    k, value = F.col("position"), F.col("value")
    is_order = value.startswith("{")
    text = (
        F.when(is_order & (k % 97 == 0), F.substring(value, 1, 20))
        .when(is_order & (k % 89 == 0), F.concat(F.lit("["), value, F.lit("]")))
        .when(is_order & (k % 83 == 0), F.regexp_replace(value, '"orderId":"[0-9]*",', ""))
        .otherwise(value)
    )
    return chunks(raw_messages(spark, sf_dir).withColumn("value", text), F.pmod("position", F.lit(MICRO_BATCHES)))


BACKLOG_FILES, FILES_A_BATCH = 8, 3


def backlog(spark: SparkSession, sf_dir: str, topic: str) -> None:
    """Hop-1 output written as a backlog of files, one after the other, dealt by position."""
    for part in chunks(etl_messages(spark, sf_dir), F.pmod("position", F.lit(BACKLOG_FILES)), BACKLOG_FILES):
        write_topic(part.coalesce(1), topic)
