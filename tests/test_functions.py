"""Edge rows of FIXTURES.md section 4 for the scalar functions and filters."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.functions import (
    int_to_ip,
    ip_to_long,
    json_field,
    lenient_int,
    millis_to_text,
    order_id_text,
    region_city,
    region_province,
    to_date_lenient,
    to_decimal_money,
    to_timestamp_lenient,
    user_id_text,
)
from tidemill.functions.time import RECORD_PATTERN
from tidemill.operators.clean import drop_empty, drop_junk, parse_document


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def apply(spark, values, fn, type_="string"):
    df = one_col(spark, values, type_).select(F.col("x"), fn(F.col("x")).alias("y"))
    return {r["x"]: r["y"] for r in df.collect()}


def test_junk_filter_truth_table(spark):
    kept = {None: False, "": True, " ": True, ",": False, " ,, ": False, "\t,\n": False, ", ,": True,
            ",a": True, "a,b": True, '{"orderId":"1"}': True}
    df = one_col(spark, list(kept)).withColumnRenamed("x", "value")
    out = {r["value"] for r in drop_junk(df).collect()}
    assert out == {k for k, v in kept.items() if v}


def test_junk_filter_looks_at_the_whole_text(spark):
    """JVM trim and split: line ends above U+0020 are text, so these records have a part."""
    texts = [f",,{end}" for end in "\u0085\u2028\u2029"] + [f"{end},," for end in "\u0085\u2028\u2029"]
    df = one_col(spark, [*texts, ",,\r\n", ",\x0b"]).withColumnRenamed("x", "value")
    assert sorted(r["value"] for r in drop_junk(df).collect()) == sorted(texts)


def test_lenient_int_equals_the_lenient_cast(spark):
    ends = ["", " ", "\t", " \n", "\x00", "\x7f", "\u0085", "\u00a0"]
    bodies = ["1.5", ".", "+.", "-.", "-", "+", "", "1.", ".5", "-0.9", "1e3", "1.5.2", "++1", "2147483647", "2147483648.1", "-2147483648", "1 2",
              "00000000000000000007", "1.x", "1,5", "0x1", "٣"]
    values = [a + b + c for b in bodies for a in ends for c in ends]
    got = apply(spark, values, lenient_int)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = apply(spark, values, lambda x: x.cast("int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == want and sum(v is not None for v in got.values()) > 300


def test_patterns_end_at_the_end(spark):
    for end in "\u0085\u2028\u2029":
        assert apply(spark, [f"1.2.3.4{end}"], ip_to_long)[f"1.2.3.4{end}"] is None
        assert apply(spark, [f"a|b|c||{end}"], region_city)[f"a|b|c||{end}"] == ""


def test_drop_empty(spark):
    df = one_col(spark, [None, "", " ", "{}"]).withColumnRenamed("x", "value")
    assert sorted(r["value"] for r in drop_empty(df).collect()) == [" ", "{}"]


@pytest.mark.parametrize(
    "text,expected",
    [("0", 0), ("-0", 0), (" 0 ", 0), ("0.5", 0), ("-0.5", 0), ("0.0", 0), (".5", 0), ("1.", 1), ("+1", 1),
     ("1.9", 1), ("abc", None), ("", None), ("true", None), ("-", None), ("0x0", None), ("1.5.2", None),
     ("1e3", None), ("3000000000", None), (None, None)],
)
def test_lenient_int(spark, text, expected):
    assert apply(spark, [text], lenient_int)[text] == expected


def test_decimal_money(spark):
    got = apply(spark, ["12.345", "-12.345", "1e3", "123456789.99", "", "abc", "7"], to_decimal_money)
    assert got == {"12.345": Decimal("12.35"), "-12.345": Decimal("-12.35"), "1e3": Decimal("1000.00"),
                   "123456789.99": None, "": None, "abc": None, "7": Decimal("7.00")}


def test_date_and_timestamp(spark):
    dates = apply(spark, ["bad", "2024-01-01 23:59:59.123", None], to_date_lenient)
    assert str(dates["2024-01-01 23:59:59.123"]) == "2024-01-01" and dates["bad"] is None
    ts = one_col(spark, ["bad", "2024-01-01 23:59:59.123"]).select(
        "x", F.date_format(to_timestamp_lenient("x"), RECORD_PATTERN).alias("y")
    )
    got = {r["x"]: r["y"] for r in ts.collect()}
    assert got == {"bad": None, "2024-01-01 23:59:59.123": "2024-01-01 23:59:59.123"}


def test_json_path_vs_struct(spark):
    texts = ['{"a":1}', '{"a":1, bad', '{"a":1.50}', '{"a":1,"a":2}', '{"a":{"b":[1]}}', "[1]", ""]
    got = apply(spark, texts, lambda c: json_field(c, "a"))
    assert got == {'{"a":1}': "1", '{"a":1, bad': None, '{"a":1.50}': "1.5", '{"a":1,"a":2}': "1",
                   '{"a":{"b":[1]}}': '{"b":[1]}', "[1]": None, "": None}


def test_document_parse_skips_undecodable(spark):
    texts = ['{"orderId":"1","orderStatus":0}', '{"orderId":"2", bad', "[1]", "null", "{}", "",
             '{"orderId":"3","orderId":"4"}']
    df = one_col(spark, texts).withColumnRenamed("x", "value")
    docs = parse_document(df).collect()
    assert sorted((d["orderId"], d["orderStatus"]) for d in docs) == [("1", "0"), ("4", None)]


@pytest.mark.parametrize(
    "region,province,city",
    [("中国|0|海南省|海口市|教育网", "海南省", "海口市"), ("a|b|c|d", "c", "d"), ("a|b|c||", "Unknown", "Unknown"),
     ("a|b", "Unknown", "Unknown"), ("", "Unknown", "Unknown"), ("||||", "Unknown", "Unknown"),
     ("a||c||e", "c", ""), (None, "Unknown", "Unknown")],
)
def test_region_split(spark, region, province, city):
    df = one_col(spark, [region]).select(region_province("x").alias("p"), region_city("x").alias("c"))
    row = df.first()
    assert (row["p"], row["c"]) == (province, city)


def test_ip_to_long(spark):
    texts = ["1.2.3.4", " 1.2.3.4 ", "255.255.255.255", None, "", "abc", "1.2.3", "1.2.3.4.5", "256.1.1.1",
             "\t10.0.0.1\n"]
    got = apply(spark, texts, ip_to_long)
    assert got == {"1.2.3.4": 16909060, " 1.2.3.4 ": 16909060, "255.255.255.255": 4294967295, None: None,
                   "": None, "abc": None, "1.2.3": None, "1.2.3.4.5": None, "256.1.1.1": None,
                   "\t10.0.0.1\n": 167772161}


def test_int_to_ip(spark):
    got = apply(spark, [-1950089216, 607649792, -1, 0], int_to_ip, "int")
    assert got == {-1950089216: "139.196.0.0", 607649792: "36.56.0.0", -1: "255.255.255.255", 0: "0.0.0.0"}


def test_time_text_and_ids(spark):
    df = spark.createDataFrame([(1704164645678, 7, 3, 123)], "t long, seq int, d int, n int")
    row = df.select(
        millis_to_text("t").alias("compact"),
        millis_to_text("t", RECORD_PATTERN).alias("record"),
        order_id_text("t", "seq").alias("oid"),
        user_id_text("d", "n").alias("uid"),
    ).first()
    assert row["compact"] == "20240102030405678"
    assert row["record"] == "2024-01-02 03:04:05.678"
    assert row["oid"] == "20240102030405678000007"
    assert row["uid"] == "300000123"


def test_json_fields_equal_path_reader(spark):
    from tidemill.functions.json import json_fields

    texts = ['{"a":1,"b":"x"}', '{"a":1,"a":2,"b":"y"}', '{"a":"\\u0041","b":1.50}', '{"\\u0061":5,"a":6}',
             '{"a":1, bad', "{'a':'1','a':'2',\"b\":\"a\"}", "[1]", "", None, '{"b":{"a":1}}', '{"a":"has \\"a\\" inside","b":null}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    fast = {r["i"]: (r["a"], r["b"]) for r in json_fields(df, "v", ["a", "b"], keep=("i",)).collect()}
    exact = {r["i"]: (r["a"], r["b"]) for r in
             df.select("i", json_field("v", "a").alias("a"), json_field("v", "b").alias("b")).collect()}
    assert fast == exact
    assert fast[1] == ("1", "y") and fast[3] == ("5", None)


def test_json_fields_property(spark):
    """Random objects with repeated, escaped and missing keys: one-parse reader == path reader."""
    import json as _json

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from tidemill.functions.json import json_fields

    names = ["a", "b", "ab"]
    value = st.one_of(st.integers(-5, 5), st.text("x\\\"0 ,", max_size=4), st.none(), st.booleans(),
                      st.floats(allow_nan=False, allow_infinity=False, width=16))
    value = st.one_of(value, st.fixed_dictionaries({"a": st.integers(0, 3)}))  # nested keys of the same name
    member = st.tuples(st.sampled_from(names + ["c"]), value, st.sampled_from(["plain", "escaped", "single"]))

    def render(members):
        parts = []
        for k, v, escape in members:
            key = "".join(f"\\u{ord(ch):04x}" for ch in k) if escape == "escaped" else k
            quote = "'" if escape == "single" else '"'
            parts.append(f"{quote}{key}{quote}:{_json.dumps(v)}")
        return "{" + ",".join(parts) + "}"

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.lists(member, max_size=4), min_size=5, max_size=25))
    def check(objects):
        texts = [render(m) for m in objects]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
        fast = sorted(tuple(r) for r in json_fields(df, "v", names, keep=("i",)).collect())
        exact = sorted(tuple(r) for r in df.select("i", *[json_field("v", n).alias(n) for n in names]).collect())
        assert fast == exact

    check()


def test_lenient_int_truncates_long_fractions(spark):
    from tidemill.functions.casts import lenient_int

    got = apply(spark, ["0.9999999999999999999", "-0.9999999999999999999", "1.9", " 7 ", ".5", "+", "1.2.3", "2147483648"], lenient_int)
    assert got == {"0.9999999999999999999": 0, "-0.9999999999999999999": 0, "1.9": 1, " 7 ": 7, ".5": 0, "+": None, "1.2.3": None,
                   "2147483648": None}


def test_json_fields_single_quoted_duplicates(spark):
    from tidemill.functions.json import json_fields

    df = spark.createDataFrame([("{'ip':'1','ip':'2',\"x\":\"ip\"}",)], "v string")
    assert json_fields(df, "v", ["ip"]).first()["ip"] == "1"
