"""The ETL hop: W3, P5, P6 and the whole stateless transform.

``etl_transform`` is one pure function over a DataFrame of messages; the
same call serves ``spark.read`` and ``spark.readStream`` input. It has no
shuffle of the message stream: the dictionary side is broadcast behind a
row bound (see ``geo.locate``), so each micro-batch is one map-only stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.json import record_json
from tidemill.operators.clean import drop_junk, message_text, parse_raw_order, position_of
from tidemill.operators.geo import locate
from tidemill.schemas import ORDER_FIELDS


def open_orders(orders: DataFrame) -> DataFrame:
    """Status 0 only; a NULL status drops."""
    return orders.filter(F.col("orderStatus") == 0)


def enrich(orders: DataFrame, ip_dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """J1/J1b + P5: add province and city resolved from ``ip``."""
    return locate(orders, ip_dim, "ip", strategy=strategy)


def etl_output(enriched: DataFrame) -> DataFrame:
    """key = orderId, value = JSON of the eight fields (NULL fields left out); the write order goes along."""
    return enriched.select(
        F.col("orderId").alias("key"), record_json(*ORDER_FIELDS).alias("value"), *position_of(enriched)
    )


def enriched_orders(messages: DataFrame, ip_dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """P1 -> W1 -> P2 -> W3 -> J: open orders with province and city, as columns."""
    keep = position_of(messages)
    parsed = parse_raw_order(drop_junk(message_text(messages, keep)), keep=keep)
    return enrich(open_orders(parsed), ip_dim, strategy)


def etl_transform(messages: DataFrame, ip_dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """Raw messages -> enriched ``(key, value)`` messages for the next hop."""
    return etl_output(enriched_orders(messages, ip_dim, strategy))
