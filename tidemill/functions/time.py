"""Time text and id formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The producer's default compact pattern and its record pattern.
COMPACT_PATTERN = "yyyyMMddHHmmssSSS"
RECORD_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_text(millis: Column | str, pattern: str = COMPACT_PATTERN) -> Column:
    """epoch milliseconds -> formatted text in the session zone."""
    return F.date_format(F.timestamp_millis(_col(millis)), pattern)


def order_id_text(millis: Column | str, sequence: Column | str) -> Column:
    """F16: 17-digit compact time followed by a 6-digit zero-padded sequence."""
    return F.concat(millis_to_text(millis), F.format_string("%06d", _col(sequence)))


def user_id_text(lead_digit: Column | str, number: Column | str) -> Column:
    """F16: one leading digit followed by an 8-digit zero-padded number."""
    return F.concat(_col(lead_digit).cast("string"), F.format_string("%08d", _col(number)))
