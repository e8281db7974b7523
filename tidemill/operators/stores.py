"""What the three keyed stores hold: cells (K2), documents (K3), wide rows (K4).

The external stores become keyed tables; writes are upserts (see
``upsert``), reads are plain DataFrame filters and joins (S6, S7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.json import parse_json_struct
from tidemill.functions.text import default_to, reverse_text
from tidemill.operators.clean import drop_empty, message_text, parse_document, position_of
from tidemill.operators.geo import bounded_side
from tidemill.schemas import ORDER_FIELDS

# The wide-row key parts used when a field is missing.
ROW_KEY_NO_USER = "unknown"
ROW_KEY_NO_TIME = "null"
DEFAULT_COUNT = "0"


# ---------------------------------------------------------------- hash cells (K2)
def writable_cells(cells: DataFrame) -> DataFrame:
    """K2 input: drop cells with a NULL key, field or value (they cannot be stored)."""
    return cells.filter(F.col("key").isNotNull() & F.col("field").isNotNull() & F.col("value").isNotNull())


def kv_get_cell(kv: DataFrame, key: str, field: str, default: str = DEFAULT_COUNT) -> DataFrame:
    """One cell as a one-row DataFrame ``value``; an absent cell reads ``default``.

    An aggregate without grouping always yields exactly one row.
    """
    hit = kv.filter((F.col("key") == key) & (F.col("field") == field))
    return hit.agg(F.coalesce(F.max("value"), F.lit(default)).alias("value"))


def kv_get(kv: DataFrame, requests: DataFrame, default: str = DEFAULT_COUNT) -> DataFrame:
    """Point reads ``requests(key, field)`` -> (key, field, value); a missing cell reads ``default``.

    The request list is computed once; it is broadcast when proven small and
    the store is streamed past it (right outer join), otherwise both sides
    shuffle on (key, field).
    """
    req = bounded_side(requests.select("key", "field"))
    cells = kv.select("key", "field", "value")
    joined = cells.join(req, ["key", "field"], "right")
    return joined.select("key", "field", default_to("value", default).alias("value"))


def kv_get_all(kv: DataFrame, key: str) -> DataFrame:
    """Every (field, value) of one hash."""
    return kv.filter(F.col("key") == key).select("field", "value")


def kv_hashes(kv: DataFrame) -> DataFrame:
    """S7 for every hash: key -> map<field, value>.

    One row per hash; a hash holds one day's provinces (or cities), a group
    bounded by the dictionary, not by the number of orders.
    """
    return kv.groupBy("key").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("fields")
    )


# ---------------------------------------------------------------- documents (K3)
def documents(messages: DataFrame) -> DataFrame:
    """P1 -> W2 -> P4 (+W5): enriched messages to eight-field text documents; no NULL ids."""
    keep = position_of(messages)
    return parse_document(drop_empty(message_text(messages, keep)), skip_corrupt=True, keep=keep)


# ---------------------------------------------------------------- wide rows (K4)
def wide_rows(messages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """P9/P10 (+W5, F9, F10, F17): row key ``reverse(userId)_orderTime`` and one text cell per column.

    A missing user gives ``unknown``, a missing time the text ``null``, a
    missing cell ``""``. Undecodable messages are skipped. The messages' write order
    (``position``) goes along where they have one.
    """
    columns = columns or ORDER_FIELDS
    names = list(dict.fromkeys(["userId", "orderTime", *columns]))
    schema = T.StructType(
        [T.StructField(n, T.StringType(), True) for n in names]
        + [T.StructField("_corrupt_record", T.StringType(), True)]
    )
    keep = position_of(messages)
    parsed = drop_empty(message_text(messages, keep)).select(
        *keep, parse_json_struct("value", schema, "_corrupt_record").alias("d")
    )
    ok = parsed.filter(F.col("d").isNotNull() & F.col("d._corrupt_record").isNull())
    row_key = F.concat(
        default_to(reverse_text("d.userId"), ROW_KEY_NO_USER),
        F.lit("_"),
        default_to("d.orderTime", ROW_KEY_NO_TIME),
    )
    return ok.select(row_key.alias("row_key"), *[default_to(f"d.{c}", "").alias(c) for c in columns], *keep)
