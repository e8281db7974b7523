"""JSON functions.

Two readers with different rules are both needed:

* ``get_json_object`` (F1) - one path per call; garbage -> NULL, first of a
  duplicated key wins. The ETL and the reports read with it.
* ``from_json`` (F2) - one parse into a declared struct; garbage -> struct of
  NULLs (or the ``_corrupt_record`` column), last duplicated key wins. The
  document and wide-row stores read with it. A string-typed field keeps
  numbers and booleans as their text (F17).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(c: Column | str, name: str) -> Column:
    """text of top-level field ``name`` (objects/arrays come back as JSON text)."""
    return F.get_json_object(_col(c), f"$.{name}")


def json_fields(df: DataFrame, column: str, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """F1 for several top-level fields at once: ``keep`` columns plus one text column per name.

    Results equal ``get_json_object(column, '$.name')`` per field, with one
    parse per row instead of one per field. ``json_tuple`` reads all fields in
    a single pass and agrees with the path reader except when a key occurs
    twice (it keeps the last, the path reader the first).

    One check per row decides whether the fast values can be used: the
    number of times any field name occurs in quotes (either style) must equal the
    number of fields ``json_tuple`` found non-NULL, and the text must have no
    ``\\u`` escape (the only way to spell a key's letters differently). A
    found field's name occurs at least once, so equality means each found
    name occurs exactly once and no other listed name occurs at all: no
    duplicate keys. Any other row (a duplicate, a key with a JSON null value,
    a name inside a string, invalid text) is read with the path reader.
    """
    v = F.col("_json_text")
    tmp = [f"_jt{i}" for i in range(len(names))]
    parsed = df.select(
        *keep, F.col(column).alias("_json_text"), F.json_tuple(F.col(column), *names).alias(*tmp)
    )
    # Both quote styles are legal around a key, for both readers.
    quoted_names = "[\"'](?:" + "|".join(r"\Q" + n + r"\E" for n in names) + ")[\"']"
    found = sum((F.col(t).isNotNull().cast("int") for t in tmp), F.lit(0))
    fast = (F.regexp_count(v, F.lit(quoted_names)) == found) & ~v.contains("\\u")
    # The flag is a generator output (one row in, one row out): a later filter on a
    # parsed field, which Catalyst pushes down and inlines, then reads the flag instead
    # of running the check a second time.
    checked = parsed.select("*", F.explode(F.array(fast)).alias("_json_fast"))
    out = [
        F.when(F.col("_json_fast"), F.col(t)).otherwise(F.get_json_object(v, f"$.{name}")).alias(name)
        for name, t in zip(names, tmp)
    ]
    return checked.select(*keep, *out)


def parse_json_struct(c: Column | str, schema: T.StructType, corrupt_column: str | None = None) -> Column:
    """parse JSON text into ``schema`` in one pass.

    With ``corrupt_column`` (a string field of ``schema``), undecodable text is
    kept there instead of failing, so callers can skip it (W5).
    """
    options = {"mode": "PERMISSIVE"}
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json(_col(c), schema, options)


def record_json(*cols: Column | str) -> Column:
    """JSON object of the given columns; NULL fields are left out."""
    return F.to_json(F.struct(*[_col(c) for c in cols]))
