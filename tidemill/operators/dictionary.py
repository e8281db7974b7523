"""Interval normalisation of an address dictionary (S5, J1): any ranges in, disjoint ranges out.

The address lookups need disjoint ranges. A real dictionary has ranges
inside ranges and across each other's borders; ``normalised`` makes them
disjoint: every address belongs to the narrowest range that holds it, and
neighbouring pieces of one region are one range again.

No range is ever compared with another, and no pair of them is formed:

* a range is cut into aligned blocks of 2^k addresses (at most two a size,
  62 in all), and the narrowest range of each block is kept, one row a block;
* the pieces of the result start where a range starts or ends, or a /16
  bucket does; such a start lies in one block of each size, so its owner is
  the narrowest among the owners of those 33 blocks, found by equality;
* pieces are ordered, and neighbours merged, inside their bucket (65,536
  addresses at most); only the pieces at a bucket's two borders, 131,072 at
  most, are then merged with each other across buckets.

Blocks of more than 2^24 addresses, which hold many starts each, are 255 rows
at most and are broadcast; the smaller ones join by a shuffle.

Defined cases: bounds outside 0..2^32-1 are cut off; ranges with a NULL bound
or ending before they start hold nothing; of ranges equally wide the one that
starts first wins, then the region first in text order (a NULL region before
any); repeated ranges count once; a NULL region is a region like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = (1 << 32) - 1
BUCKET_BITS = 16
LARGE_BITS = 24  # blocks above this size are broadcast


def _power(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), k)


def _clipped(ip_dim: DataFrame) -> DataFrame:
    lo, hi = F.greatest(F.col("ip_lo"), F.lit(0)).cast("bigint"), F.least(F.col("ip_hi"), F.lit(TOP)).cast("bigint")
    sound = ip_dim.filter("ip_lo IS NOT NULL AND ip_hi IS NOT NULL").select(lo.alias("lo"), hi.alias("hi"), F.col("region").cast("string").alias("region"))
    return sound.filter("lo <= hi").distinct()


def _blocks(ranges: DataFrame) -> DataFrame:
    """(bits, start, owner): the narrowest range of every aligned block that some range is made of."""
    sized = ranges.withColumn("bits", F.explode(F.sequence(F.lit(0), F.lit(32)))).withColumn("size", _power(F.col("bits")))
    # What is left of the range once all smaller blocks are taken off both of its ends.
    left = F.floor((F.col("lo") + F.col("size") - 1) / F.col("size")).cast("bigint")
    right = F.floor((F.col("hi") + 1) / F.col("size")).cast("bigint")
    ends = sized.withColumns({"left": left, "right": right})
    at_left = (F.col("left") % 2 == 1) & (F.col("left") < F.col("right"))
    at_right = (F.col("right") % 2 == 1) & (F.col("left") + at_left.cast("int") < F.col("right"))
    starts = F.array_compact(F.array(F.when(at_left, F.col("left")), F.when(at_right, F.col("right") - 1)))
    owner = F.struct((F.col("hi") - F.col("lo")).alias("width"), "lo", "hi", "region")
    return ends.select("bits", F.explode(starts).alias("block"), owner.alias("owner")).groupBy("bits", "block").agg(F.min("owner").alias("owner"))


def _starts(ranges: DataFrame) -> DataFrame:
    """Where a piece of the result may start: at a range's start, behind its end, and at the start of every bucket it touches."""
    edges = ranges.select(F.explode(F.array(F.col("lo"), F.col("hi") + 1)).alias("at")).filter(F.col("at") <= TOP)
    spans = ranges.select(F.shiftright("lo", BUCKET_BITS).alias("a"), F.shiftright("hi", BUCKET_BITS).alias("b")).distinct()
    buckets = spans.select(F.explode(F.sequence("a", "b")).alias("bucket")).distinct()
    return edges.unionByName(buckets.select(F.call_function("shiftleft", F.col("bucket"), F.lit(BUCKET_BITS)).alias("at"))).distinct()


def _pieces(ranges: DataFrame) -> DataFrame:
    """(bucket, lo, hi, owner) of every piece that some range holds."""
    blocks, starts = _blocks(ranges), _starts(ranges)
    keys = starts.withColumn("bits", F.explode(F.sequence(F.lit(0), F.lit(32))))
    keys = keys.withColumn("block", F.call_function("shiftright", F.col("at"), F.col("bits")))
    small = keys.filter(F.col("bits") <= LARGE_BITS).join(blocks.filter(F.col("bits") <= LARGE_BITS), ["bits", "block"])
    large = keys.filter(F.col("bits") > LARGE_BITS).join(F.broadcast(blocks.filter(F.col("bits") > LARGE_BITS)), ["bits", "block"])
    owned = small.unionByName(large).groupBy("at").agg(F.min("owner").alias("owner"))
    bucket = F.shiftright("at", BUCKET_BITS).alias("bucket")
    # A start that nothing holds still ends the piece before it.
    all_starts = starts.join(owned, "at", "left").select(bucket, "at", "owner")
    behind = F.lead("at").over(Window.partitionBy("bucket").orderBy("at"))
    last = F.call_function("shiftleft", F.col("bucket") + 1, F.lit(BUCKET_BITS))
    ended = all_starts.withColumn("hi", F.coalesce(behind, last) - 1)
    return ended.filter("owner IS NOT NULL").select("bucket", F.col("at").alias("lo"), "hi", F.col("owner.region").alias("region"))


def _merged(pieces: DataFrame, by: list[Column]) -> DataFrame:
    """Neighbouring pieces of one region as one, within ``by``."""
    order = Window.partitionBy(*by).orderBy("lo")
    joins = F.lag("region").over(order).eqNullSafe(F.col("region")) & (F.lag("hi").over(order) + 1 == F.col("lo"))
    runs = pieces.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy(*by, "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("region").alias("region"))


def normalised(ip_dim: DataFrame) -> DataFrame:
    """(ip_lo, ip_hi, region): disjoint ranges, no two neighbours of one region."""
    inner = _merged(_pieces(_clipped(ip_dim)), [F.col("bucket")])
    first, behind = F.call_function("shiftleft", F.col("bucket"), F.lit(BUCKET_BITS)), F.call_function("shiftleft", F.col("bucket") + 1, F.lit(BUCKET_BITS))
    at_border = (F.col("lo") == first) | (F.col("hi") + 1 == behind)
    across = _merged(inner.filter(at_border).select("lo", "hi", "region", F.lit(0).alias("all")), [F.col("all")])
    return inner.filter(~at_border).select("lo", "hi", "region").unionByName(across.select("lo", "hi", "region")).select(
        F.col("lo").alias("ip_lo"), F.col("hi").alias("ip_hi"), "region"
    )
