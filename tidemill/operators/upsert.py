"""Keyed upserts as aggregations: U1 (replace) and U2 (field-wise merge).

Both are written as ``groupBy(key).agg(max(struct(order..., value)))``
rather than a ``row_number`` window. A window sends every version of a key
to one task; the aggregate is combined map-side first, so a key with a third
of all versions is reduced inside each map task and only one row per key
and task crosses the shuffle.

``order`` is a list of columns giving the write order (for example
``(batch_id, position)``); ties are broken by the rest of the row, so the
result is the same whatever order the rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_by_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Per key, the whole row of the last write replaces everything before it."""
    payload = [c for c in df.columns if c not in keys]
    ordering = [o.alias(f"_o{i}") for i, o in enumerate(_as_cols(order))]
    last = F.max(F.struct(*ordering, *[F.col(c) for c in payload])).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in payload])


def merge_by_key(df: DataFrame, keys: list[str], order: list, fields: list[str] | None = None, ties: bool = True) -> DataFrame:
    """Per key and field, the last non-NULL value; a NULL never overwrites.

    Rows of equal order are told apart by their fields taken together, one
    tie-break for all of them: where two such rows both set a field, the same
    row wins it as wins every other. Where a key's rows all differ in their
    order, ``ties=False`` leaves that out, and each field's candidate carries
    its own value only.
    """
    fields = fields or [c for c in df.columns if c not in keys]
    tie = [F.struct(*fields).alias("_tie")] if ties else []
    ordering = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(_as_cols(order))], *tie)
    aggs = [
        F.max(F.when(F.col(f).isNotNull(), F.struct(ordering.alias("_ord"), F.col(f).alias("v")))).alias(f)
        for f in fields
    ]
    return df.groupBy(*keys).agg(*aggs).select(*keys, *[F.col(f"{f}.v").alias(f) for f in fields])
