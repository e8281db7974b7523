"""IP address -> (province, city): J1, J1b, and the broadcast guard.

The reference looks each address up in a B-tree file inside a row-at-a-time
UDF. Here the lookup is a join against the dictionary table
``ip_dim(ip_lo, ip_hi, region)`` (disjoint, inclusive, unsigned ranges):

* each /16 bucket of the address space becomes one row holding the sorted
  ranges that touch it (at most 65,536, the addresses of a bucket);
* an order joins its bucket's row by equality, one hash probe, and finds its
  range in the sorted array by binary search: the cost of an order is the
  logarithm of the ranges in its bucket, and no pair of order and range is
  ever formed.

``broadcast`` (``range``, ``prefix``) joins against the broadcast buckets: a
map-only stage. ``shuffle`` is the same join for a dictionary beyond the
broadcast bound, hash-partitioned on (bucket, salt) with the buckets
replicated once per salt, so one hot bucket is spread over as many tasks as
its size asks for. Addresses that cannot match (NULL or malformed) do not
enter that join. AQE's skew-join split applies on top.

``auto`` broadcasts when the buckets' size in bytes is within the bound and
shuffles otherwise.

A dictionary that serves more than one query is built once
(``build_dictionary``): its buckets and their size are then at hand, and a
lookup adds no job of its own. One that is too large to broadcast is kept as
a table bucketed by (bucket, salt) (``save_dictionary_table``): the lookup
(``locate_table``) then moves orders only, and never explodes or shuffles the
dictionary again.

Ranges that nest or cross are made disjoint first (``dictionary.normalised``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.ip import ip_to_long
from tidemill.functions.text import UNKNOWN, region_city, region_province
from tidemill.session import checkpoint_root, scratch_path

BUCKET_BITS = 16
# What is broadcast is measured first, in bytes of its rows.
BROADCAST_MAX_BYTES = 64 << 20
# Orders of one bucket a task of the salted join should see, and salts where the input cannot be counted (a stream).
ROWS_PER_SALT = 1_000_000
STREAM_SALTS = 16


_BUCKETS = "_d_bucket bigint, _d_ranges array<struct<lo: bigint, hi: bigint, province: string, city: string>>"


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16
    return F.lit(16)


def table_bytes(df: DataFrame) -> int:
    """About how many bytes the rows of ``df`` take in memory (16 a value, and the length of each text)."""
    widths = [_width(f) for f in df.schema.fields]
    return df.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, widths).cast("long")), F.lit(0))).first()[0]


def bounded_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """A derived join side, computed once, broadcast only if measured small.

    The side is materialized with ``checkpoint()`` in the session's shared
    checkpoint folder (which also cuts its lineage), so measuring it and then
    joining it does not run its plan twice; it is broadcast when its rows take
    at most ``max_bytes``, and joined by shuffle otherwise.
    """
    checkpoint_root(df.sparkSession)  # make sure a checkpoint folder is registered
    saved = df.checkpoint(eager=True)
    return F.broadcast(saved) if table_bytes(saved) <= max_bytes else saved


def bucket_table(ip_dim: DataFrame) -> DataFrame:
    """One row per /16 bucket: its ranges sorted by their first address, region already split."""
    # F11 runs once per dictionary range here, not once per order after the join.
    cut = ip_dim.select(
        F.explode(F.sequence(F.shiftright("ip_lo", BUCKET_BITS), F.shiftright("ip_hi", BUCKET_BITS))).alias("_d_bucket"),
        F.struct(
            F.col("ip_lo").alias("lo"),
            F.col("ip_hi").alias("hi"),
            region_province("region").alias("province"),
            region_city("region").alias("city"),
        ).alias("r"),
    )
    return cut.groupBy("_d_bucket").agg(F.sort_array(F.collect_list("r")).alias("_d_ranges"))


def _buckets_bytes(ip_dim: DataFrame) -> int:
    """Size of the bucket table without building it: every range once for each bucket it touches."""
    copies = F.shiftright("ip_hi", BUCKET_BITS) - F.shiftright("ip_lo", BUCKET_BITS) + 1
    row = copies * (F.coalesce(F.octet_length("region"), F.lit(0)) + 64)
    return ip_dim.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


@dataclass(frozen=True)
class Dictionary:
    """A dictionary's buckets, built and measured."""

    buckets: DataFrame
    size: int  # bytes, about


def open_dictionary(spark: SparkSession, path: str) -> Dictionary:
    """The buckets that ``build_dictionary`` wrote, measured by one scan of them."""
    buckets = spark.read.schema(_BUCKETS).parquet(path)
    one = F.transform("_d_ranges", lambda r: 64 + F.coalesce(F.octet_length(r["province"]), F.lit(0)) + F.coalesce(F.octet_length(r["city"]), F.lit(0)))
    row = F.aggregate(one, F.lit(64).cast("long"), lambda a, x: a + x)
    return Dictionary(buckets, buckets.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0])


def _built(ip_dim: DataFrame, path: str | None = None) -> str:
    """Write the buckets as Parquet at ``path``, or under the shared checkpoint folder."""
    path = path or scratch_path(ip_dim.sparkSession, "dictionary")
    bucket_table(ip_dim).write.mode("overwrite").parquet(path)
    return path


def build_dictionary(ip_dim: DataFrame, path: str | None = None) -> Dictionary:
    """Build the buckets once, for any number of lookups and for a stream's many batches."""
    return open_dictionary(ip_dim.sparkSession, _built(ip_dim, path))


def _found(columns: list[str]) -> list[Column]:
    """Output columns: the last range that starts at or before the address, if it reaches it."""
    ranges, ip = F.col("_d_ranges"), F.col("_ip_num")
    powers = F.transform(
        F.sequence(F.floor(F.log2(F.size(ranges))).cast("int"), F.lit(0)),
        lambda b: F.call_function("shiftleft", F.lit(1), b),
    )
    step = lambda n, p: F.when(F.get(ranges, n + p - 1)["lo"] <= ip, n + p).otherwise(n)
    last = F.get(ranges, F.aggregate(powers, F.lit(0), step) - 1)
    # Bound once per row: the two columns below read it.
    hit = F.element_at(F.transform(F.array(last), lambda r: F.when(r["hi"] >= ip, r)), 1)
    place = F.when(ranges.isNotNull(), hit)
    # No match (NULL, malformed or unknown address) -> Unknown, like a region with too few parts.
    both = F.struct(
        F.coalesce(place["province"], F.lit(UNKNOWN)).alias("province"), F.coalesce(place["city"], F.lit(UNKNOWN)).alias("city")
    )
    return [*[F.col(c) for c in columns], both.alias("_place")]


def _finish(joined: DataFrame, columns: list[str]) -> DataFrame:
    return joined.select(*_found(columns)).select(*columns, "_place.province", "_place.city")


def _probe(df: DataFrame, ip_col: str) -> DataFrame:
    return df.withColumn("_ip_num", ip_to_long(ip_col)).withColumn("_bucket", F.shiftright("_ip_num", BUCKET_BITS))


def locate_broadcast(df: DataFrame, ip_dim: DataFrame | Dictionary, ip_col: str = "ip") -> DataFrame:
    """J1/J1b with the buckets broadcast. Call through ``locate``, which measures them first.

    A plain dictionary's buckets are written first, once also for a stream's many batches.
    """
    spark = df.sparkSession
    buckets = ip_dim.buckets if isinstance(ip_dim, Dictionary) else spark.read.schema(_BUCKETS).parquet(_built(ip_dim))
    joined = _probe(df, ip_col).join(F.broadcast(buckets), F.col("_bucket") == F.col("_d_bucket"), "left")
    return _finish(joined, df.columns)


def _salts(probe: DataFrame) -> int:
    """Enough salts that a task sees about ``ROWS_PER_SALT`` orders of the largest bucket."""
    if probe.isStreaming:
        return STREAM_SALTS
    top = probe.filter("_bucket IS NOT NULL").groupBy("_bucket").count().agg(F.max("count")).first()[0] or 0
    return max(1, -(-top // ROWS_PER_SALT))


def locate_shuffle(df: DataFrame, ip_dim: DataFrame | Dictionary, ip_col: str = "ip", salts: int | None = None) -> DataFrame:
    """J1b without broadcast: salted shuffle join on (bucket, salt); addresses that match nothing stay out of it."""
    columns = df.columns
    probe = _probe(df, ip_col)
    salts = salts or _salts(probe)
    salted = probe.filter("_bucket IS NOT NULL").withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts)))
    buckets = ip_dim.buckets if isinstance(ip_dim, Dictionary) else bucket_table(ip_dim)
    table = buckets.withColumn("_d_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = salted.join(table, (F.col("_bucket") == F.col("_d_bucket")) & (F.col("_salt") == F.col("_d_salt")), "left")
    unknown = probe.filter("_bucket IS NULL").select(*columns, F.lit(UNKNOWN).alias("province"), F.lit(UNKNOWN).alias("city"))
    return _finish(joined, columns).unionByName(unknown)


@dataclass(frozen=True)
class DictionaryTable:
    """A dictionary kept as a table bucketed by (bucket, salt)."""

    spark: SparkSession
    name: str
    salts: int


def save_dictionary_table(ip_dim: DataFrame, name: str, path: str, parts: int, salts: int = STREAM_SALTS) -> DictionaryTable:
    """Write the buckets, once for each salt, as table ``name`` at ``path``, bucketed into ``parts`` files by (bucket, salt).

    ``salts`` is how many tasks the orders of one bucket are dealt to;
    ``parts`` is the number of shuffle partitions of the lookups.
    """
    spark = ip_dim.sparkSession
    salted = bucket_table(ip_dim).withColumn("_d_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = salted.select((F.col("_d_bucket") * salts + F.col("_d_salt")).alias("_d_key"), "_d_ranges")
    writer = keyed.repartition(parts, "_d_key").write.mode("overwrite").option("path", path)
    writer.bucketBy(parts, "_d_key").sortBy("_d_key").saveAsTable(name)
    return DictionaryTable(spark, name, salts)


def register_dictionary_table(spark: SparkSession, name: str, path: str, parts: int, salts: int = STREAM_SALTS) -> DictionaryTable:
    """Make known to this session a table that another one has written with the same ``parts`` and ``salts``."""
    columns = _BUCKETS.replace("_d_bucket", "_d_key")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (_d_key) SORTED BY (_d_key) INTO {parts} BUCKETS LOCATION '{path}'")
    return DictionaryTable(spark, name, salts)


def locate_table(df: DataFrame, table: DictionaryTable, ip_col: str = "ip") -> DataFrame:
    """J1b against a stored dictionary: one shuffle, of the orders with a well-formed address, on (bucket, salt)."""
    columns = df.columns
    probe = _probe(df, ip_col)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(table.salts))
    keyed = probe.filter("_bucket IS NOT NULL").withColumn("_key", F.col("_bucket") * table.salts + salt)
    # The hash side is a table file of one partition; orders are neither sorted nor collected.
    stored = table.spark.table(table.name).hint("shuffle_hash")
    joined = keyed.join(stored, F.col("_key") == F.col("_d_key"), "left")
    unknown = probe.filter("_bucket IS NULL").select(*columns, F.lit(UNKNOWN).alias("province"), F.lit(UNKNOWN).alias("city"))
    return _finish(joined, columns).unionByName(unknown)


def locate(
    df: DataFrame,
    ip_dim: DataFrame | Dictionary | DictionaryTable,
    ip_col: str = "ip",
    strategy: str = "auto",
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Add ``province`` and ``city`` for the address in ``ip_col``.

    NULL, blank, malformed and out-of-dictionary addresses, and regions with
    fewer than four parts, give ("Unknown", "Unknown"). Every input row is
    kept exactly once (ranges are disjoint). ``range`` and ``prefix`` name the
    same join, J1's condition evaluated through J1b's buckets. A dictionary
    may be its plain table, built (``Dictionary``) or stored (``DictionaryTable``).
    """
    if strategy not in ("auto", "range", "prefix", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if isinstance(ip_dim, DictionaryTable):
        return locate_table(df, ip_dim, ip_col)
    # Every broadcast is behind a measured bound; beyond it, the salted shuffle join gives the same rows.
    size = ip_dim.size if isinstance(ip_dim, Dictionary) else None if strategy == "shuffle" else _buckets_bytes(ip_dim)
    if strategy != "shuffle" and size <= broadcast_max_bytes:
        return locate_broadcast(df, ip_dim, ip_col)
    return locate_shuffle(df, ip_dim, ip_col, salts)
