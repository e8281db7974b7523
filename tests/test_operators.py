"""Operators: join-strategy equivalence, report identities, upserts, stores, offsets."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.operators import geo
from tidemill.operators import report as R
from tidemill.operators.dictionary import normalised
from tidemill.operators.offsets import number_log, resume, save_offsets
from tidemill.operators.stores import kv_get, wide_rows, writable_cells
from tidemill.operators.upsert import latest_by_key, merge_by_key
from tidemill.plans import scenarios as X
from tidemill.sources.fixtures import CITIES


def ip_text(n):
    return ".".join(str((n >> s) & 255) for s in (24, 16, 8, 0))


@pytest.fixture(scope="module")
def crafted_dim(spark):
    # Disjoint ranges: inside one /16, spanning many /16s, unaligned, a /8, and a region with too few parts.
    ranges = [
        (167772160, 167837695, "CN|0|P0|C0|isp"),  # 10.0.0.0/16
        (167837696, 167837951, "CN|0|P1|C1|isp"),  # 10.1.0.0/24
        (167838000, 168100000, "CN|0|P2|C2|isp"),  # unaligned, crosses several /16 borders
        (184549376, 201326591, "CN|0|P3|C3|isp"),  # 11.0.0.0/8: 256 buckets
        (3232235776, 3232236031, "bad|region"),  # 192.168.1.0/24, fewer than 4 parts
        (4294967040, 4294967295, "x|y|P4|C4"),  # top of the address space
    ]
    return spark.createDataFrame(ranges, "ip_lo bigint, ip_hi bigint, region string"), ranges


def expected_location(ip, ranges):
    from tidemill.functions.text import UNKNOWN

    if ip is None:
        return (UNKNOWN, UNKNOWN)
    t = ip.strip()
    parts = t.split(".")
    if len(parts) != 4 or not all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts):
        return (UNKNOWN, UNKNOWN)
    n = (int(parts[0]) << 24) + (int(parts[1]) << 16) + (int(parts[2]) << 8) + int(parts[3])
    for lo, hi, region in ranges:
        if lo <= n <= hi:
            p = region.rstrip("|").split("|")
            return (p[2], p[3]) if len(p) >= 4 else (UNKNOWN, UNKNOWN)
    return (UNKNOWN, UNKNOWN)


def test_range_strategies_agree_with_brute_force(spark, crafted_dim):
    dim, ranges = crafted_dim
    rnd = random.Random(7)
    ips = []
    for lo, hi, _ in ranges:
        ips += [ip_text(lo), ip_text(hi), ip_text(lo - 1), ip_text(min(hi + 1, 2**32 - 1))]
        ips += [ip_text(rnd.randint(lo, hi)) for _ in range(20)]
    ips += [ip_text(rnd.randint(0, 2**32 - 1)) for _ in range(200)]
    ips += [None, "", "  ", "abc", "1.2.3", "256.1.1.1", " 10.0.0.5 ", "11.2.3.4"]
    orders = spark.createDataFrame([(str(i), ip) for i, ip in enumerate(ips)], "orderId string, ip string")
    want = {str(i): expected_location(ip, ranges) for i, ip in enumerate(ips)}
    for strategy in ("range", "prefix", "shuffle", "auto"):
        got = geo.locate(orders, dim, "ip", strategy=strategy).collect()
        assert len(got) == len(ips), strategy
        assert {r["orderId"]: (r["province"], r["city"]) for r in got} == want, strategy


def test_auto_strategy_falls_back_beyond_bounds(spark, crafted_dim):
    dim, ranges = crafted_dim
    orders = spark.createDataFrame([("1", "11.0.0.1"), ("2", None)], "orderId string, ip string")
    got = geo.locate(orders, dim, strategy="auto", broadcast_max_bytes=3).collect()
    assert {r["orderId"]: r["province"] for r in got} == {"1": "P3", "2": "Unknown"}


def test_prefix_join_plans_as_hash_join(spark, crafted_dim):
    dim, _ = crafted_dim
    orders = spark.createDataFrame([("1", "10.0.0.1")], "orderId string, ip string")
    plan = geo.locate_broadcast(orders, dim)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


@pytest.fixture(scope="module")
def report_rows(spark):
    return X.report_rows(spark, SF_SMALL).cache()


def test_city_list_equals_city_table(spark, report_rows):
    table = spark.createDataFrame([(c,) for c in CITIES], "city string")
    a = R.daily_by_city(report_rows, CITIES).collect()
    b = R.daily_by_city(report_rows, city_table=table).collect()
    assert sorted(a) == sorted(b) and len(a) > 0


def test_grouping_sets_equal_three_reports(spark, report_rows):
    sets = {(r["key"], r["field"], r["value"]) for r in R.sets_to_cells(R.daily_sets(report_rows, CITIES)).collect()}
    separate = set()
    for cells in (R.daily_total(report_rows), R.daily_by_province(report_rows), R.daily_by_city(report_rows, CITIES)):
        separate |= {(r["key"], r["field"], r["value"]) for r in cells.collect()}
    assert sets == separate


def test_province_sums_equal_total(spark, report_rows):
    prov = R.daily_by_province(report_rows).withColumn("day", F.substring_index("key", ":", -1))
    per_day = prov.groupBy("day").agg(F.sum(F.col("value").cast("decimal(20,2)")).alias("s"))
    total = R.daily_total(report_rows).select(F.substring_index("key", ":", -1).alias("day"),
                                              F.col("value").cast("decimal(20,2)").alias("t"))
    assert per_day.join(total, "day").filter(F.col("s") != F.col("t")).count() == 0


def test_null_group_keys(spark):
    rows = spark.createDataFrame(
        [(None, Decimal("1.50"), None, None), ("2024-01-01", Decimal("2.00"), None, "X"),
         ("2024-01-01", None, "P", "NATION_1")],
        "d string, money decimal(10,2), province string, city string",
    ).select(F.col("d").cast("date").alias("order_date"), "money", "province", "city")
    total = {r["key"]: r["value"] for r in R.daily_total(rows).collect()}
    assert total == {"orders:money:total": "1.50", "orders:money:total:2024-01-01": "2.00"}
    prov = R.daily_by_province(rows).collect()
    assert ("orders:money:province:2024-01-01", "P", None) in [tuple(r) for r in prov]
    assert writable_cells(R.daily_by_province(rows)).count() == 0  # NULL field or NULL value cells


def test_document_and_series_shape(spark, report_rows):
    sets = R.daily_sets(report_rows, CITIES)
    doc = R.report_document(sets)
    assert [f.name for f in doc.schema.fields] == ["date", "total_sales", "province_sales", "city_sales"]
    series = R.report_series(doc)
    first = series.filter(F.col("ordinal") == 0).select("label").distinct().collect()
    assert [r["label"] for r in first] == ["Total"]
    assert series.filter(F.col("ordinal") == 0).count() == doc.count()


def test_replace_upsert_is_order_independent(spark):
    rows = [("k1", 1, "a"), ("k1", 3, "c"), ("k1", 2, "b"), ("k2", 5, "x"), ("k2", 5, "y")]
    df = spark.createDataFrame(rows, "key string, seq int, v string")
    got = {r["key"]: (r["seq"], r["v"]) for r in latest_by_key(df, ["key"], ["seq"]).collect()}
    assert got == {"k1": (3, "c"), "k2": (5, "y")}  # tie broken by the rest of the row
    shuffled = spark.createDataFrame(list(reversed(rows)), "key string, seq int, v string").repartition(3)
    assert sorted(latest_by_key(shuffled, ["key"], ["seq"]).collect()) == sorted(
        latest_by_key(df, ["key"], ["seq"]).collect()
    )


def test_merge_upsert_keeps_last_non_null(spark):
    rows = [("d", "1", "a1", None), ("d", "2", None, "b2"), ("d", "10", None, None), ("e", "3", None, None)]
    df = spark.createDataFrame(rows, "id string, orderId string, a string, b string")
    got = {r["id"]: (r["orderId"], r["a"], r["b"]) for r in
           merge_by_key(df, ["id"], [F.col("orderId").cast("int")]).collect()}
    assert got == {"d": ("10", "a1", "b2"), "e": ("3", None, None)}


def test_upsert_aggregates_map_side(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("key"), F.col("id").alias("seq"), F.lit("v").alias("v"))
    plan = latest_by_key(df, ["key"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "partial_" in plan


def test_wide_row_edges(spark):
    msgs = spark.createDataFrame(
        [('{"orderId":"1","userId":"100000123","orderTime":"t","orderStatus":0}',),
         ('{"orderId":"2","orderTime":"t"}',), ('{"orderId":"3","userId":"12"}',), ("garbage",), ("",)],
        "value string",
    )
    rows = {r["orderId"]: r for r in wide_rows(msgs).collect()}
    assert rows["1"]["row_key"] == "321000001_t" and rows["1"]["orderStatus"] == "0" and rows["1"]["ip"] == ""
    assert rows["2"]["row_key"] == "unknown_t"
    assert rows["3"]["row_key"] == "21_null"
    assert len(rows) == 3


def test_merge_ties_never_mix_versions(spark):
    """Rows of equal order: one row wins every field that both of them set."""
    rows = [("7", 1, "9", "A"), ("7", 1, "10", "B")]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "id string, seq int, ip string, city string")
        got = merge_by_key(df, ["id"], ["seq"], ["ip", "city"]).collect()
        assert [tuple(r)[1:] for r in got] in ([("9", "A")], [("10", "B")])


def test_kv_get_all(spark):
    from tidemill.operators.stores import kv_get_all

    kv = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("b", "x", "3")], "key string, field string, value string")
    assert sorted(tuple(r) for r in kv_get_all(kv, "a").collect()) == [("x", "1"), ("y", "2")]


def test_kv_get_default(spark):
    kv = spark.createDataFrame([("a", "global", "5.00")], "key string, field string, value string")
    req = spark.createDataFrame([("a", "global"), ("b", "global")], "key string, field string")
    assert {r["key"]: r["value"] for r in kv_get(kv, req).collect()} == {"a": "5.00", "b": "0"}


def test_offsets_numbering_matches_brute_force(spark):
    rnd = random.Random(3)
    # Partition 0 holds most records (skew); ids are sparse.
    recs = []
    next_id = 0
    for _ in range(3000):
        next_id += rnd.randint(1, 5)
        recs.append((next_id, 0 if rnd.random() < 0.7 else rnd.randint(1, 2)))
    df = spark.createDataFrame(recs, "id long, partition int")
    unnumbered = spark.createDataFrame([(5, None), (None, 1)], "id long, partition int")
    assert number_log(unnumbered, "t", "partition", "id").count() == 2  # NULLs are numbered too, not lost
    got = {r["id"]: r["offset"] for r in number_log(df, "t", "partition", "id").collect()}
    counters, want = {}, {}
    for i, p in recs:
        want[i] = counters.get(p, 0)
        counters[p] = want[i] + 1
    assert got == want
    log = number_log(df, "t", "partition", "id")
    ledger = spark.createDataFrame([("t", 0, 100)], "topic string, partition int, from_offset long")
    pending = resume(log, ledger)
    assert pending.count() == len(recs) - 100
    new = {r["partition"]: r["from_offset"] for r in save_offsets(ledger, pending).collect()}
    assert new == {p: n for p, n in counters.items()}


def test_kv_get_cell_default(spark):
    from tidemill.operators.stores import kv_get_cell

    kv = spark.createDataFrame([("a", "global", "5.00")], "key string, field string, value string")
    assert kv_get_cell(kv, "a", "global").collect()[0]["value"] == "5.00"
    assert kv_get_cell(kv, "b", "global").collect()[0]["value"] == "0"


def test_named_strategies_check_their_bound(spark, crafted_dim):
    dim, ranges = crafted_dim
    orders = spark.createDataFrame([("1", "11.0.0.1"), ("2", "10.0.0.9")], "orderId string, ip string")
    for strategy in ("range", "prefix"):
        df = geo.locate(orders, dim, strategy=strategy, broadcast_max_bytes=2)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan, strategy  # over the bound: shuffled, not broadcast
        assert {r["orderId"]: r["province"] for r in df.collect()} == {"1": "P3", "2": "P0"}


def test_range_join_property(spark):
    """Random disjoint dictionaries (wide, narrow, unaligned) and addresses: all strategies = brute force."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    bounds = st.lists(st.integers(0, 2**32 - 1), min_size=2, max_size=16, unique=True).map(sorted)
    regions = st.sampled_from(["c|r|P1|C1|i", "c|r|P2|C2", "c|r|P3||", "short", "a||P4||e"])

    @settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
    @given(bounds, st.lists(regions, min_size=8, max_size=8), st.lists(st.integers(0, 2**32 - 1), max_size=40))
    def check(cuts, names, extra):
        ranges = [(cuts[i], cuts[i + 1] - 1, names[i % len(names)]) for i in range(0, len(cuts) - 1, 2)]
        ips = [ip_text(n) for lo, hi, _ in ranges for n in (lo, hi, (lo + hi) // 2)] + [ip_text(n) for n in extra]
        dim = spark.createDataFrame(ranges, "ip_lo bigint, ip_hi bigint, region string")
        orders = spark.createDataFrame([(str(i), ip) for i, ip in enumerate(ips)], "orderId string, ip string")
        want = {str(i): expected_location(ip, ranges) for i, ip in enumerate(ips)}
        for strategy in ("range", "prefix", "shuffle"):
            got = geo.locate(orders, dim, strategy=strategy).collect()
            assert {r["orderId"]: (r["province"], r["city"]) for r in got} == want, strategy

    check()


# ---------------------------------------------------------------- dictionary normalisation
def disjoint(rows):
    """Narrowest range first, point by point."""
    top = (1 << 32) - 1
    sound = [(max(0, a), min(top, b), r) for a, b, r in rows if a is not None and b is not None]
    sound = [x for x in sound if x[0] <= x[1]]
    points = sorted({a for a, _, _ in sound} | {b + 1 for _, b, _ in sound})
    out = []
    for p, q in zip(points, points[1:]):
        holders = [(b - a, a, r is not None, r or "", r) for a, b, r in sound if a <= p <= b]
        if not holders:
            continue
        region = min(holders)[-1]
        if out and out[-1][1] + 1 == p and out[-1][2] == region:
            out[-1] = (out[-1][0], q - 1, region)
        else:
            out.append((p, q - 1, region))
    return out


def dictionary(spark, rows):
    return spark.createDataFrame(rows, "ip_lo long, ip_hi long, region string")


@pytest.mark.parametrize("seed", [1, 2])
def test_normalised_dictionary_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(50):
        start = rng.choice([rng.randrange(200_000), rng.randrange(1 << 22), (1 << 32) - rng.randrange(1, 100_000)])
        rows.append((start, start + rng.randint(0, rng.choice([0, 1, 5, 300, 65536, 70000, 1 << 20])), rng.choice(["A", "B", "C", None])))
    rows += [(5, 3, "backwards"), (None, 4, "open"), (-5, 2, "below"), rows[0], (rows[1][0], rows[1][1], "Z")]
    assert sorted(tuple(r) for r in normalised(dictionary(spark, rows)).collect()) == disjoint(rows)


def test_normalised_nested_range_and_the_whole_space(spark):
    rows = [(0, 1000, "outer"), (100, 200, "inner"), (201, 300, "inner"), (0, (1 << 32) + 9, "world")]
    want = [(0, 99, "outer"), (100, 300, "inner"), (301, 1000, "outer"), (1001, (1 << 32) - 1, "world")]
    assert sorted(tuple(r) for r in normalised(dictionary(spark, rows)).collect()) == want == disjoint(rows)
    assert normalised(dictionary(spark, [])).count() == 0


def test_lookup_through_a_nested_dictionary(spark):
    dim = dictionary(spark, [(0, 1000, "c|0|Outer|O|i"), (100, 200, "c|0|Inner|I|i")])
    orders = spark.createDataFrame([("0.0.0.99",), ("0.0.0.100",), ("0.0.0.200",), ("0.0.0.201",), ("0.0.1.0",), ("0.0.4.0",)], "ip string")
    got = {r["ip"]: r["province"] for r in geo.locate(orders, normalised(dim)).collect()}
    assert got == {"0.0.0.99": "Outer", "0.0.0.100": "Inner", "0.0.0.200": "Inner", "0.0.0.201": "Outer", "0.0.1.0": "Outer", "0.0.4.0": "Unknown"}


def test_stored_dictionaries_give_the_same_places(spark, scratch, crafted_dim):
    dim, ranges = crafted_dim
    rng = random.Random(8)
    texts = [ip_text(rng.choice([lo, hi, lo - 1, hi + 1, rng.randint(lo, hi)]) % (1 << 32)) for lo, hi, _ in ranges for _ in range(20)]
    orders = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "bad", ""])], "n int, ip string")
    want = sorted(geo.locate(orders, dim).collect())
    built = geo.build_dictionary(dim)
    assert built.size > 0 and sorted(geo.locate(orders, built).collect()) == want
    assert sorted(geo.locate(orders, built, strategy="shuffle").collect()) == want
    assert sorted(geo.locate(orders, built, broadcast_max_bytes=0).collect()) == want  # too large by its measure
    path = scratch("dictionary")
    table = geo.save_dictionary_table(dim, "crafted_dictionary", path, parts=4, salts=3)
    assert sorted(geo.locate(orders, table).collect()) == want
    again = geo.register_dictionary_table(spark, "crafted_dictionary_again", path, parts=4, salts=3)
    assert sorted(geo.locate(orders, again).collect()) == want
    for name in ("crafted_dictionary", "crafted_dictionary_again"):
        spark.sql(f"DROP TABLE {name}")
