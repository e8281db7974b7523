"""IPv4 text <-> number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.text import jvm_trim

_OCTET = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DOTTED = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ip_to_long(c: Column | str) -> Column:
    """dotted IPv4 text -> unsigned number 0..2^32-1; anything else -> NULL.

    Surrounding blanks are ignored; each octet must be 0..255.
    """
    text = jvm_trim(c)
    parts = F.split(text, r"\.")
    number = (
        parts.getItem(0).try_cast("bigint") * F.lit(16777216)
        + parts.getItem(1).try_cast("bigint") * F.lit(65536)
        + parts.getItem(2).try_cast("bigint") * F.lit(256)
        + parts.getItem(3).try_cast("bigint")
    )
    return F.when(text.rlike(_DOTTED), number)


def int_to_ip(c: Column | str) -> Column:
    """signed 32-bit address number -> dotted text (-1950089216 -> 139.196.0.0)."""
    x = _col(c).cast("bigint")
    octets = [F.shiftright(x, s).bitwiseAND(F.lit(255)) for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *[o.cast("string") for o in octets])
