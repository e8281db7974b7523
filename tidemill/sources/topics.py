"""Message topics.

A topic is a stream of ``(key, value)`` text messages, each with its
``position`` in the write order: the offset in Kafka (an order's messages
share a key and so a partition), a column of the files otherwise. With the Kafka
connector deployed it is read with ``format("kafka")``; without it (as in
this install) a topic is a directory of Parquet files, which keeps NULL and
multi-line values intact and gives the same ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.schemas import MESSAGE


def write_topic(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Append messages to a file topic (one batch write = one set of new files)."""
    position = F.col("position") if "position" in messages.columns else F.lit(None)
    out = messages.select(F.col("key").cast("string"), F.col("value").cast("string"), position.cast("bigint").alias("position"))
    if files:
        out = out.repartition(files)
    out.write.mode("append").parquet(path)


def read_topic(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    fmt: str = "parquet",
    max_per_trigger: int | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Read a topic as ``(key, value, position)`` (P1), batch or streaming.

    ``fmt="kafka"`` subscribes to topic ``path``; ``max_per_trigger`` maps to
    ``maxOffsetsPerTrigger`` there and to ``maxFilesPerTrigger`` for files (S4).
    """
    reader = spark.readStream if streaming else spark.read
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("subscribe", path)
        if streaming and max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
        df = reader.format("kafka").options(**opts).load().withColumnRenamed("offset", "position")
    else:
        if streaming and max_per_trigger:
            opts["maxFilesPerTrigger"] = str(max_per_trigger)
        df = reader.format(fmt).schema(MESSAGE).options(**opts).load(path)
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "position")
