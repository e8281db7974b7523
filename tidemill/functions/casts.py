"""Lenient casts.

Spark 4 runs in ANSI mode, where a plain ``cast`` of bad text throws. The
pipeline must instead turn bad text into NULL, as a non-ANSI cast does, so
every cast here is a ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.schemas import SALES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What a non-ANSI cast strips from both ends: blanks and control characters.
_CAST_BLANKS = "".join(chr(i) for i in [*range(0x21), 0x7F])


def lenient_int(c: Column | str) -> Column:
    """text -> int like a non-ANSI cast.

    An optional sign, digits, and a fraction that is cut off (``'1.9'`` -> 1,
    ``'-0.5'`` -> 0); either side of the point may be empty, both too (``'.'`` ->
    0). Blanks and control characters around it are ignored; a bare sign,
    exponents, words and overflow give NULL.
    """
    text = F.trim(_col(c), F.lit(_CAST_BLANKS))
    whole = F.regexp_extract(text, r"^([+-]?[0-9]*)", 1)
    number = F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int"))
    valid = text.rlike(r"^[+-]?[0-9]*(\.[0-9]*)?\z") & ~text.isin("", "+", "-")
    return F.when(valid, number)


def to_decimal_money(c: Column | str) -> Column:
    """text -> decimal(10,2), half-up rounding; overflow or bad text -> NULL."""
    return _col(c).try_cast("decimal(10,2)")


def to_date_lenient(c: Column | str) -> Column:
    """date part of a date/timestamp text, in the session zone; bad -> NULL."""
    return _col(c).try_cast("date")


def to_timestamp_lenient(c: Column | str) -> Column:
    """timestamp text (ms precision kept) in the session zone; bad -> NULL."""
    return F.try_to_timestamp(_col(c))


def sales(c: Column | str) -> Column:
    """Pin a sum of money to decimal(20,2), the width Spark gives sum(decimal(10,2))."""
    return _col(c).cast(SALES)
