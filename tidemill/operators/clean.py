"""Message cleaning and parsing: W1 W2 W5, P1-P4.

All predicates are native expressions, so Catalyst can see into them and
keep them inside whole-stage codegen (the reference used opaque lambdas).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.casts import lenient_int, to_date_lenient, to_decimal_money, to_timestamp_lenient
from tidemill.functions.json import json_fields, parse_json_struct
from tidemill.schemas import DOCUMENT, DOCUMENT_WITH_CORRUPT

# A record is junk when, trimmed like String.trim, it is one or more commas and
# nothing else (a JVM split on "," then has no parts). The empty string is not junk.
_COMMAS_ONLY = r"^[\x00-\x20]*,+[\x00-\x20]*\z"  # not $, which also matches before a final line end


def message_text(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The message value as a string column ``value`` (plus any ``keep`` columns)."""
    return messages.select(*keep, F.col("value").cast("string").alias("value"))


def position_of(messages: DataFrame) -> tuple[str, ...]:
    """The write-order column to carry along, where the messages have one."""
    return ("position",) if "position" in messages.columns else ()


def drop_junk(df: DataFrame, column: str = "value") -> DataFrame:
    """Drop NULL records and records that are only commas (and blanks)."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.rlike(_COMMAS_ONLY))


def drop_empty(df: DataFrame, column: str = "value") -> DataFrame:
    """Drop NULL (tombstone) and empty messages."""
    c = F.col(column)
    return df.filter(c.isNotNull() & (c != ""))


_RAW_FIELDS = ["orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus"]


def parse_raw_order(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Six order fields by JSON path (one parse per row); the status through the lenient int cast."""
    fields = json_fields(df, column, _RAW_FIELDS, keep)
    return fields.select(*keep, *_RAW_FIELDS[:-1], lenient_int("orderStatus").alias("orderStatus"))


def parse_report_input(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """(order_date, order_timestamp, money decimal(10,2), province, city)."""
    fields = json_fields(df, column, ["orderTime", "orderMoney", "province", "city"], keep)
    return fields.select(
        *keep,
        to_date_lenient("orderTime").alias("order_date"),
        to_timestamp_lenient("orderTime").alias("order_timestamp"),
        to_decimal_money("orderMoney").alias("money"),
        "province",
        "city",
    )


def parse_document(
    df: DataFrame, column: str = "value", skip_corrupt: bool = True, keep: tuple[str, ...] = ()
) -> DataFrame:
    """P4 (+W5): typed parse into the eight text fields, then flatten.

    With ``skip_corrupt`` undecodable text (garbage, truncated, arrays,
    ``null``) and rows without an order id are dropped instead of becoming
    all-NULL documents.
    """
    if not skip_corrupt:
        return df.select(parse_json_struct(column, DOCUMENT).alias("data"), *keep).select("data.*", *keep)
    parsed = df.select(*keep, parse_json_struct(column, DOCUMENT_WITH_CORRUPT, "_corrupt_record").alias("data"))
    return parsed.filter(
        F.col("data").isNotNull() & F.col("data._corrupt_record").isNull() & F.col("data.orderId").isNotNull()
    ).select(*[F.col(f"data.{f.name}").alias(f.name) for f in DOCUMENT.fields], *keep)


#: Why a message is no document, in the order of the checks.
NO_VALUE, EMPTY, UNDECODABLE, NO_ID = "no value", "empty", "undecodable", "no order id"


def judge_document(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P4 W2 W5 in one pass: the eight text fields, the message's ``value`` and ``reason``, NULL where it is a document."""
    text = message_text(messages, keep)
    parsed = text.select("*", parse_json_struct("value", DOCUMENT_WITH_CORRUPT, "_corrupt_record").alias("data"))
    reason = (
        F.when(F.col("value").isNull(), NO_VALUE)
        .when(F.col("value") == "", EMPTY)
        .when(F.col("data").isNull() | F.col("data._corrupt_record").isNotNull(), UNDECODABLE)
        .when(F.col("data.orderId").isNull(), NO_ID)
    )
    return parsed.select(*[F.col(f"data.{f.name}").alias(f.name) for f in DOCUMENT.fields], *keep, "value", reason.alias("reason"))
