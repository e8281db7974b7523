"""Declared schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# The eight order fields, in record order.
ORDER_FIELDS = ["orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus", "province", "city"]

# A message on a topic: key and value text (the value is what jobs read), and its place in the write order.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("position", T.LongType(), True),
    ]
)

# Document schema (P4): all eight fields read as text.
DOCUMENT = T.StructType([T.StructField(name, T.StringType(), True) for name in ORDER_FIELDS])

# Document schema with the corrupt-record column used to skip undecodable text.
DOCUMENT_WITH_CORRUPT = T.StructType(
    DOCUMENT.fields + [T.StructField("_corrupt_record", T.StringType(), True)]
)

# IP dictionary: inclusive, disjoint, unsigned ranges and the region text.
IP_DIM = T.StructType(
    [
        T.StructField("ip_lo", T.LongType(), False),
        T.StructField("ip_hi", T.LongType(), False),
        T.StructField("region", T.StringType(), True),
    ]
)

SALES = T.DecimalType(20, 2)
