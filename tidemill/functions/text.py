"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# JVM String.trim strips every char <= U+0020 at both ends; Spark's one-argument
# trim only strips spaces, so the JVM set is passed as the trim set.
_JVM_BLANKS = "".join(chr(i) for i in range(0x21))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c: Column | str) -> Column:
    """trim like ``String.trim`` (all control chars and space)."""
    return F.trim(_col(c), F.lit(_JVM_BLANKS))


def reverse_text(c: Column | str) -> Column:
    """reversed string (row-key salting)."""
    return F.reverse(_col(c))


def default_to(c: Column | str, value) -> Column:
    """NULL -> ``value``."""
    return F.coalesce(_col(c), F.lit(value))


def _region_parts(region: Column | str) -> Column:
    # JVM split drops trailing empty strings; strip trailing separators first.
    return F.split(F.regexp_replace(_col(region), r"\|+\z", ""), r"\|")


def _region_part(region: Column | str, position: int) -> Column:
    parts = _region_parts(region)
    return F.when(F.size(parts) >= 4, F.try_element_at(parts, F.lit(position))).otherwise(F.lit(UNKNOWN))


def region_province(region: Column | str) -> Column:
    """third '|' part of ``country|region|province|city|isp``; fewer than 4 parts or NULL -> Unknown."""
    return _region_part(region, 3)


def region_city(region: Column | str) -> Column:
    """fourth '|' part; fewer than 4 parts or NULL -> Unknown."""
    return _region_part(region, 4)
