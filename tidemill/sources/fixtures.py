"""Order messages and the IP dictionary, derived from the supplied tables.

The reference reads orders as JSON text from a topic and resolves addresses
with a dictionary file that is not shipped. Both are derived here from the
TPC-H-like tables (see FIXTURES.md section 3), so every query's work grows
with the tables.

* ``raw_order``: one order record per row of ``orders`` joined to its
  customer. The join is left to the planner: broadcast only if the
  customer side is small by Spark's own size estimate, sort-merge otherwise,
  with AQE splitting a skewed customer.
* ``raw_messages``: each record as JSON text, plus junk lines (NULL,
  comma-only, blank) that a topic shared by other producers carries.
* ``ip_dim``: one /16 range per nation (province = region name, city =
  nation name) and one wide range crossing /16 borders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.ip import int_to_ip
from tidemill.functions.json import record_json
from tidemill.functions.time import RECORD_PATTERN, millis_to_text
from tidemill.sources.tables import load_table, spread

# Junk message texts, chosen per junk slot in this order.
JUNK_TEXTS = [None, ",", " ,, ", "\t,\n", ", ,", ""]
# One junk line follows every order whose key is a multiple of this.
JUNK_EVERY = 101

# The wide dictionary range (11.0.0.0 onwards, crossing /16 borders).
WIDE_RANGE = (184549376, 184849376, "X|0|WIDE|WIDE_CITY|isp")

# The range around all nations' ranges (10.0.0.0/8), which the narrower ones take their addresses from.
AROUND_RANGE = (167772160, 184549375, "X|0|NET10|NET10_CITY|isp")

# Milliseconds between the fixture's times of a day.
DAY_STEP_MS = 28_799_877

# The nine allow-listed cities of the fixture dictionary.
CITIES = ["NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5", "NATION_6", "NATION_7", "NATION_8"]


def raw_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orderId, userId, orderTime, ip, orderMoney (double) and orderStatus (int), plus the write position."""
    orders = spread(
        load_table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
        )
    )
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    lo, hi, _ = WIDE_RANGE
    # Every 43rd order lies in the wide range: at its borders, just past it, or somewhere inside.
    place = F.pmod(F.floor(k / 43), F.lit(4))
    inside = F.lit(lo) + F.pmod(k * 31, F.lit(hi - lo + 1))
    wide = F.when(place == 0, F.lit(lo)).when(place == 1, F.lit(hi)).when(place == 2, F.lit(hi + 1)).otherwise(inside)
    ip = (
        F.when(k % 50 == 0, F.lit(None).cast("string"))
        .when(k % 49 == 0, F.lit("bad-ip"))
        .when(k % 47 == 0, F.lit("192.168.1.1"))
        .when(k % 43 == 0, int_to_ip(wide.cast("bigint")))
        .otherwise(
            F.concat(
                F.lit("10."),
                F.col("c_nationkey").cast("string"),
                F.lit("."),
                (k % 256).cast("string"),
                F.lit("."),
                (F.col("o_custkey") % 256).cast("string"),
            )
        )
    )
    status = (
        F.when(F.col("o_orderstatus") == "O", F.lit(0))
        .when(F.col("o_orderstatus") == "P", F.lit(1))
        .otherwise(F.lit(2))
    )
    # One of three times of the day, to the millisecond.
    at = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + (k % 3) * F.lit(DAY_STEP_MS)
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").select(
        k.alias("position"),
        k.cast("string").alias("orderId"),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("userId"),
        millis_to_text(at, RECORD_PATTERN).alias("orderTime"),
        ip.alias("ip"),
        F.col("o_totalprice").cast("decimal(10,2)").cast("double").alias("orderMoney"),
        status.alias("orderStatus"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source topic: one JSON message per order, and a junk line after every ``JUNK_EVERY``-th.

    Both come from one scan of the orders (an ``explode`` of one or two
    messages per order). The order key is the messages' ``position`` in the write order.
    """
    r = raw_order(spark, sf_dir)
    k = F.col("position")
    text = record_json("orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus")
    slot = F.pmod(F.floor(k / JUNK_EVERY), F.lit(len(JUNK_TEXTS)))
    junk = F.element_at(F.array(*[F.lit(t).cast("string") for t in JUNK_TEXTS]), (slot + 1).cast("int"))
    values = F.when(k % JUNK_EVERY == 0, F.array(text, junk)).otherwise(F.array(text))
    return r.select(F.lit(None).cast("string").alias("key"), F.explode(values).alias("value"), "position")


def ip_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary ranges (ip_lo, ip_hi, region) derived from nation and region."""
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    base = F.lit(10).cast("bigint") * F.lit(16777216) + F.col("n_nationkey").cast("bigint") * F.lit(65536)
    per_nation = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        base.alias("ip_lo"),
        (base + F.lit(65535)).alias("ip_hi"),
        F.concat(F.lit("X|0|"), F.col("r_name"), F.lit("|"), F.col("n_name"), F.lit("|isp")).alias("region"),
    )
    lo, hi, text = WIDE_RANGE
    wide = spark.range(1).select(
        F.lit(lo).cast("bigint").alias("ip_lo"), F.lit(hi).cast("bigint").alias("ip_hi"), F.lit(text).alias("region")
    )
    return per_nation.unionByName(wide)


def nested_ip_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary as address registries give it: ranges inside ranges and across each other's borders.

    Around ``ip_dim`` lies one wide range; inside it every supplier has a
    range of some hundred addresses in its nation's /16, which crosses its
    neighbours' and at times the nation's border.
    """
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = load_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey").cast("bigint")
    base = F.lit(AROUND_RANGE[0]).cast("bigint") + F.col("n_nationkey").cast("bigint") * F.lit(65536)
    lo = base + F.pmod(k * 37, F.lit(256)) * 256 + 100
    text = F.concat(F.lit("X|0|"), F.col("r_name"), F.lit("|"), F.col("s_name"), F.lit("|isp"))
    placed = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    own = placed.select(lo.alias("ip_lo"), (lo + 300 + F.pmod(k, F.lit(200))).alias("ip_hi"), text.alias("region"))
    first, last, name = AROUND_RANGE
    around = spark.range(1).select(F.lit(first).cast("bigint").alias("ip_lo"), F.lit(last).cast("bigint").alias("ip_hi"), F.lit(name).alias("region"))
    return ip_dim(spark, sf_dir).unionByName(own).unionByName(around)
