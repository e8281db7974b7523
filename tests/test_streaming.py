"""Streaming: batch = stream, late data (FIXTURES section 5), replay, keyed tables, restart."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.operators import report as R
from tidemill.operators.clean import judge_document
from tidemill.operators.stores import wide_rows
from tidemill.operators.upsert import latest_by_key, merge_by_key
from tidemill.plans import scenarios as X
from tidemill.sources.fixtures import CITIES, ip_dim
from tidemill.sources.topics import read_topic, write_topic
from tidemill.streaming import KeyedTable, pipeline as P


ONE = P.Topics(max_per_trigger=1)


def message(spark, t, money="1.00"):
    value = json.dumps({"orderId": "1", "orderTime": t, "orderMoney": money, "province": "P", "city": "C"})
    return spark.createDataFrame([(None, value)], "key string, value string")


def late_data_topic(spark, scratch, times):
    topic = scratch("late")
    for t in times:
        write_topic(message(spark, t).coalesce(1), topic)
    return topic


def test_parity_form_keeps_late_rows(spark, scratch):
    topic = late_data_topic(spark, scratch, ["2024-01-01 10:00:00", "2024-01-05 10:00:00", "2024-01-05 11:00:00",
                                             "2024-01-01 11:00:00"])
    store = scratch("kv")
    watch = P.watch_late_rows(spark)
    queries = P.start_reports(spark, topic, store, scratch("ckpt"), CITIES, ONE, which=("total",), query_suffix="-late")
    P.run(queries)
    cells = {r["key"]: r["value"] for r in P.report_tables(spark, store)["total"].read().collect()}
    assert cells == {"orders:money:total:2024-01-01": "2.00", "orders:money:total:2024-01-05": "2.00"}
    assert P.dropped_by_watermark(watch, queries[0]) == 0
    spark.streams.removeListener(watch)


def test_bounded_form_drops_late_rows(spark, scratch):
    topic = late_data_topic(spark, scratch, ["2024-01-01 10:00:00", "2024-01-05 10:00:00", "2024-01-05 11:00:00",
                                             "2024-01-01 11:00:00"])
    watch = P.watch_late_rows(spark)
    query, table = P.start_bounded_daily(spark, topic, scratch("bounded"), scratch("ckpt"), ONE)
    P.run([query])
    got = {str(r["order_date"]): str(r["total_amt"]) for r in table.read().collect()}
    assert got == {"2024-01-01": "1.00", "2024-01-05": "2.00"}
    assert P.dropped_by_watermark(watch, query) == 1
    spark.streams.removeListener(watch)


def test_bounded_form_accepts_late_row_within_one_batch_grace(spark, scratch):
    topic = late_data_topic(spark, scratch, ["2024-01-01 10:00:00", "2024-01-05 10:00:00", "2024-01-01 11:00:00"])
    query, table = P.start_bounded_daily(spark, topic, scratch("bounded"), scratch("ckpt"), ONE)
    P.run([query])
    got = {str(r["order_date"]): str(r["total_amt"]) for r in table.read().collect()}
    assert got == {"2024-01-01": "2.00", "2024-01-05": "1.00"}


def test_replay_of_a_batch_changes_nothing(spark, scratch):
    table = KeyedTable(spark, scratch("kv"), ["key", "field"])
    b0 = spark.createDataFrame([("k", "f", "1.00"), ("k", "g", "2.00")], "key string, field string, value string")
    b1 = spark.createDataFrame([("k", "f", "3.00")], "key string, field string, value string")
    table.apply_batch(b0, 0)
    table.apply_batch(b1, 1)
    first = sorted(table.read().collect())
    table.apply_batch(b1, 1)  # replay
    table.apply_batch(b0.limit(0), 2)  # empty batch: skipped
    assert sorted(table.read().collect()) == first == [("k", "f", "3.00"), ("k", "g", "2.00")]


def test_stream_etl_equals_batch(spark, scratch):
    source, out, ckpt = scratch("raw"), scratch("etl"), scratch("ckpt")
    dim = ip_dim(spark, SF_SMALL)
    X.feed(source, X.raw_arrivals(spark, SF_SMALL), lambda: P.run([P.start_etl(spark, source, out, ckpt, dim, ONE)]))
    streamed = sorted(read_topic(spark, out).collect())
    batch = sorted(X.etl_messages(spark, SF_SMALL).collect())
    assert streamed == batch and len(batch) > 0


def test_restart_equals_one_pass(spark, scratch):
    source, etl, store, ckpt = scratch("raw"), scratch("etl"), scratch("kv"), scratch("ckpt")

    def both_hops():
        P.run([P.start_etl(spark, source, etl, f"{ckpt}/etl", ip_dim(spark, SF_SMALL), ONE)])
        P.run(P.start_reports(spark, etl, store, f"{ckpt}/rep", CITIES, ONE, query_suffix="-restart"))

    arrivals = X.raw_arrivals(spark, SF_SMALL)
    X.feed(source, arrivals, both_hops, only=[0])
    X.feed(source, arrivals, lambda: None, only=[1])
    X.feed(source, arrivals, both_hops, only=[2])
    both_hops()  # nothing new: no change
    got = sorted(P.report_tables(spark, store)["province"].read().collect())
    want = sorted(R.daily_by_province(X.report_rows(spark, SF_SMALL)).collect())
    assert got == want


def test_wide_row_stream_overwrites_same_key(spark, scratch):
    topic = scratch("wide")
    rows = [
        '{"orderId":"1","userId":"12","orderTime":"t","ip":"a"}',
        '{"orderId":"2","userId":"12","orderTime":"t","ip":"b"}',
        '{"orderId":"3","userId":"12","orderTime":"u"}',
    ]
    for r in rows:
        write_topic(spark.createDataFrame([(None, r)], "key string, value string").coalesce(1), topic)
    store = scratch("wide-store")
    P.run([P.start_wide_rows(spark, topic, store, scratch("ckpt"), ONE)])
    got = {r["row_key"]: (r["orderId"], r["ip"]) for r in P.wide_row_table(spark, store).read().collect()}
    assert got == {"21_t": ("2", "b"), "21_u": ("3", "")}


def test_document_stream_merges_fields(spark, scratch):
    topic = scratch("docs")
    for r in ['{"orderId":"7","ip":"a","city":"C"}', '{"orderId":"7","province":"P"}', "garbage"]:
        write_topic(spark.createDataFrame([(None, r)], "key string, value string").coalesce(1), topic)
    store = scratch("doc-store")
    P.run([P.start_documents(spark, topic, store, scratch("ckpt"), ONE)])
    doc = P.document_table(spark, store).read().collect()
    assert len(doc) == 1
    assert (doc[0]["ip"], doc[0]["province"], doc[0]["city"]) == ("a", "P", "C")


def test_processing_time_trigger_builds(spark):
    # The deployment trigger (every 5 s) is a plain option on the same writer.
    trig = P.Trigger(processing_time="5 seconds")
    df = spark.readStream.format("rate").load().select(F.col("value"))
    writer = trig.apply(df.writeStream.format("noop"))
    assert writer is not None


def test_one_pass_report_stream_equals_batch_sets(spark, scratch):
    topic, store, ckpt = scratch("etl"), scratch("cells"), scratch("ckpt")
    X.feed(topic, X.etl_arrivals(spark, SF_SMALL),
           lambda: P.run([P.start_reports_one_pass(spark, topic, store, ckpt, CITIES)]))
    got = sorted(tuple(r) for r in P.cell_table(spark, store).read().select("grain", "key", "field", "value").collect())
    want = sorted(tuple(r) for r in R.sets_to_cells(X.sets(spark, SF_SMALL)).collect())
    assert got == want and len(want) > 0


CELLS = "key string, field string, value string"


def kept(table):
    return sorted(tuple(r) for r in table.read().select("key", "field", "value").collect())


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, scratch):
    table = KeyedTable(spark, scratch("kv"), ["key", "field"], buckets=8)
    table.apply_batch(spark.createDataFrame([(f"k{i}", "f", "1") for i in range(100)], CELLS), 0)
    assert set(table.versions()) == set(range(8)) and {v for _, v in table.versions().values()} == {0}
    table.apply_batch(spark.createDataFrame([("k7", "f", "2")], CELLS), 1)
    versions = table.versions()
    assert sorted(v for _, v in versions.values()) == [0] * 7 + [1]
    assert sorted(s for s, _ in versions.values()) == [0] * 7 + [1]
    assert dict((k, v) for k, _, v in kept(table))["k7"] == "2" and len(kept(table)) == 100


def test_many_batches_replayed_by_a_new_writer(spark, scratch):
    """Every batch once by one writer, then again by another that knows nothing but the files."""
    rng = random.Random(1)
    path, want = scratch("kv"), {}
    batches = [[(f"k{rng.randint(0, 30)}", "f", f"{b}-{i}") for i in range(rng.randint(1, 8))] for b in range(5)]
    batches = [list({k: (k, f, v) for k, f, v in rows}.values()) for rows in batches]
    for b, rows in enumerate(batches):
        KeyedTable(spark, path, ["key", "field"], buckets=4).apply_batch(spark.createDataFrame(rows, CELLS), b)
        want |= {k: (k, f, v) for k, f, v in rows}
        again = KeyedTable(spark, path, ["key", "field"], buckets=4)
        before = again.versions()
        again.apply_batch(spark.createDataFrame(rows, CELLS), b)
        assert again.versions() == before and kept(again) == sorted(want.values())


def test_a_half_written_batch_is_finished_by_its_replay(spark, scratch):
    """A batch that reached some of its buckets only: the replay writes the others and leaves those alone."""
    table = KeyedTable(spark, scratch("kv"), ["key", "field"], buckets=4)
    rows = [(f"k{i}", "f", "1") for i in range(40)]
    table.apply_batch(spark.createDataFrame(rows, CELLS), 0)
    second = spark.createDataFrame([(k, f, "2") for k, f, _ in rows], CELLS)
    part = second.filter(table._bucket_of() < 2)
    KeyedTable(spark, table.path, ["key", "field"], buckets=4).apply_batch(part, 1)
    assert len({v for _, v in table.versions().values()}) == 2
    KeyedTable(spark, table.path, ["key", "field"], buckets=4).apply_batch(second, 1)
    assert {v for _, v in table.versions().values()} == {1} and {v for _, _, v in kept(table)} == {"2"}


def test_a_failed_write_leaves_the_newest_version(spark, scratch):
    table = KeyedTable(spark, scratch("kv"), ["key", "field"], buckets=2)
    table.apply_batch(spark.createDataFrame([(f"k{i}", "f", "1") for i in range(10)], CELLS), 0)
    before = kept(table)
    broken = spark.createDataFrame([("k1", "f", "x")], CELLS).withColumn("value", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.apply_batch(broken, 1)
    assert kept(table) == before
    table.apply_batch(spark.createDataFrame([("k1", "f", "2")], CELLS), 1)
    assert dict((k, v) for k, _, v in kept(table))["k1"] == "2"


def test_a_planned_read_keeps_its_files(spark, scratch):
    """A read planned before a batch still finds its files after it."""
    table = KeyedTable(spark, scratch("kv"), ["key", "field"], buckets=1)
    table.apply_batch(spark.createDataFrame([("k", "f", "1")], CELLS), 0)
    planned = table.read()
    table.apply_batch(spark.createDataFrame([("k", "f", "2")], CELLS), 1)
    assert [r["value"] for r in planned.collect()] == ["1"] and kept(table) == [("k", "f", "2")]


def test_a_read_opens_only_the_buckets_asked_for(spark, scratch):
    table = KeyedTable(spark, scratch("kv"), ["key", "field"], buckets=16, bucket_by=["key"])
    table.apply_batch(spark.createDataFrame([(f"k{i}", f, "1") for i in range(200) for f in "ab"], CELLS), 0)
    asked = spark.createDataFrame([("k3",), ("nowhere",)], "key string")
    buckets = {r[0] for r in asked.select(table._bucket_of()).collect()}
    found = table.read_for(asked)
    opened = {int(f.split("_bucket=")[1].split("/")[0]) for f in found.inputFiles()}
    assert opened <= buckets and len(table.read().inputFiles()) == 16
    assert sorted(r["field"] for r in found.filter("key = 'k3'").collect()) == ["a", "b"]
    assert table.read([]).count() == 0


def test_another_number_of_buckets_is_refused(spark, scratch):
    table = KeyedTable(spark, scratch("kv"), ["key", "field"], buckets=4)
    assert table.read() is None and table.read_for(spark.createDataFrame([("a", "b")], "key string, field string")) is None
    table.apply_batch(spark.createDataFrame([("k", "f", "1")], CELLS), 0)
    with pytest.raises(ValueError, match="4 buckets"):
        KeyedTable(spark, table.path, ["key", "field"], buckets=8).apply_batch(spark.createDataFrame([("k", "f", "2")], CELLS), 1)
    assert kept(KeyedTable(spark, table.path, ["key", "field"], buckets=8)) == [("k", "f", "1")]


def test_merge_mode_over_buckets(spark, scratch):
    table = KeyedTable(spark, scratch("docs"), ["id"], order=["position"], mode="merge", buckets=2)
    schema = "id string, a string, b string, position long"
    table.apply_batch(spark.createDataFrame([("1", "x", None, 5), ("1", None, "y", 6), ("2", "p", "q", 7)], schema), 0)
    table.apply_batch(spark.createDataFrame([("1", None, "z", 1), ("1", "w", None, 0)], schema), 1)  # a later batch wins, whatever its places
    assert sorted(tuple(r) for r in table.read().select("id", "a", "b").collect()) == [("1", "w", "z"), ("2", "p", "q")]


def test_a_batch_plan_runs_once(spark, scratch):
    runs = spark.sparkContext.accumulator(0)

    def touched(x):
        runs.add(1)
        return x

    touch = F.udf(touched, "string")
    table = KeyedTable(spark, scratch("kv"), ["key"], prepare=lambda b: b.withColumn("value", touch("value")))
    table.apply_batch(spark.createDataFrame([(str(i), "v") for i in range(20)], "key string, value string"), 0)
    assert runs.value == 20
    assert table.read().count() == 20


def put(order, user, t, position, ip):
    return (None, json.dumps({"orderId": order, "userId": user, "orderTime": t, "ip": ip}), position)


def test_stores_do_not_depend_on_batch_boundaries(spark, scratch):
    """One batch, two, or one for each message leave equal documents and wide rows, in write order."""
    schema = "key string, value string, position long"
    messages = [put("9", "12", "t", 0, "a"), put("3", "12", "t", 1, "b"), put("7", "5", "u", 2, "9"), put("7", "5", "u", 3, "10"),
                put("7", "5", "u", 4, None)]
    seen = set()
    for cuts in ([5], [2, 3], [3, 2], [1, 1, 1, 1, 1]):
        topic, at = scratch("versions"), 0
        for n in cuts:
            write_topic(spark.createDataFrame(messages[at : at + n], schema).coalesce(1), topic)
            at += n
        wide, docs = scratch("wide"), scratch("docs")
        P.run([P.start_wide_rows(spark, topic, wide, scratch("ckpt"), ONE)])
        P.run([P.start_documents(spark, topic, docs, scratch("ckpt"), ONE)])
        rows = sorted((r["row_key"], r["orderId"], r["ip"]) for r in P.wide_row_table(spark, wide).read().collect())
        documents = sorted((r["orderId"], r["ip"]) for r in P.document_table(spark, docs).read().collect())
        seen.add((tuple(rows), tuple(documents)))
    assert seen == {((("21_t", "3", "b"), ("5_u", "7", "")), (("3", "b"), ("7", "10"), ("9", "a")))}


def test_wide_rows_of_chosen_columns(spark, scratch):
    topic, store = scratch("wide"), scratch("wide-store")
    write_topic(spark.createDataFrame([put("1", "12", "t", 0, "a"), put("2", "12", "t", 1, "b")],
                                      "key string, value string, position long"), topic)
    P.run([P.start_wide_rows(spark, topic, store, scratch("ckpt"), columns=["ip"])])
    assert [tuple(r) for r in P.wide_row_table(spark, store).read().select("row_key", "ip").collect()] == [("21_t", "b")]


# ---------------------------------------------------------------- latest by key as state
def test_state_keeps_the_last_write_in_any_arrival_order(spark, scratch):
    schema = "key string, value string, position long"
    topic, store, ckpt = scratch("wide"), scratch("store"), scratch("ckpt")

    def run(*messages):
        write_topic(spark.createDataFrame(list(messages), schema).coalesce(1), topic)
        query = P.start_wide_rows_state(spark, topic, store, ckpt)  # every run is a restart from the checkpoint
        P.run([query])
        return sorted((r["row_key"], r["orderId"], r["ip"]) for r in P.wide_state_table(spark, store).read().collect())

    assert run(put("1", "12", "t", 5, "a"), put("2", "12", "t", 9, "b")) == [("21_t", "2", "b")]
    assert run(put("3", "12", "t", 7, "late")) == [("21_t", "2", "b")]  # an earlier write told later
    assert run(put("4", "12", "t", 10, None), put("5", "34", "u", 1, "c")) == [("21_t", "4", ""), ("43_u", "5", "c")]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    state = P.state_table(spark, ckpt)
    assert {r["key"]["row_key"] for r in state.collect()} == {"21_t", "43_u"}


# ---------------------------------------------------------------- state as a table
def test_state_rows_of_the_late_data_stream(spark, scratch):
    """FIXTURES section 5, read from the state store batch by batch."""
    topic = late_data_topic(spark, scratch, ["2024-01-01 10:00:00", "2024-01-05 10:00:00", "2024-01-05 11:00:00", "2024-01-01 11:00:00"])
    ckpt = scratch("ckpt")
    P.run([P.start_bounded_daily(spark, topic, scratch("bounded"), f"{ckpt}/bounded", ONE)[0]])
    P.run(P.start_reports(spark, topic, scratch("kv"), ckpt, CITIES, ONE, which=("total",), query_suffix="-state"))
    rows = lambda path, b: P.state_table(spark, path, b).count()
    assert [rows(f"{ckpt}/bounded", b) for b in range(4)] == [1, 2, 1, 1]
    assert [rows(f"{ckpt}/amt-total", b) for b in range(4)] == [1, 2, 2, 2]
    assert P.last_state_batch(spark, f"{ckpt}/amt-total") >= 3


# ---------------------------------------------------------------- late rows (T5)
def test_late_rows_by_batch_equal_the_listener(spark, scratch):
    """A day of its own for each late row, so that the stream's count, taken after partial sums, counts rows."""
    batches = [["2024-01-20 10:00:00", "2024-01-19 10:00:00"], ["2024-01-01 10:00:00", "2024-01-25 00:05:00"],
               ["2024-01-02 10:00:00", "2024-01-24 23:59:59.999", "2024-01-24 10:00:00"], ["2024-01-03 10:00:00", "2024-01-04 10:00:00", "2024-01-24 11:00:00", "2024-01-26 10:00:00"]]
    topic, ckpt = scratch("late"), scratch("ckpt")
    for times in batches:
        frame = spark.createDataFrame([(None, json.dumps({"orderId": "1", "orderTime": t, "orderMoney": "1"})) for t in times], "key string, value string")
        write_topic(frame.coalesce(1), topic)
    watch = P.watch_late_rows(spark)
    query, _ = P.start_bounded_daily(spark, topic, scratch("bounded"), ckpt, ONE)
    P.run([query])
    rows = spark.createDataFrame([(i, t) for i, times in enumerate(batches) for t in [*times, None]], "batch int, t string")
    judged = P.late_by_batch(rows.withColumn("at", F.to_timestamp("t")), "batch", "at")
    got = {r["batch"]: (r["kept"], r["dropped"], r["untimed"]) for r in judged.collect()}
    # Batch 1 has its grace; 2024-01-25 00:05 less ten minutes is still the 24th, so batch 3 keeps that day.
    assert got == {0: (2, 0, 1), 1: (2, 0, 1), 2: (2, 1, 1), 3: (2, 2, 1)}
    assert sum(d for _, d, _ in got.values()) == P.dropped_by_watermark(watch, query)
    spark.streams.removeListener(watch)


# ---------------------------------------------------------------- one read, several stores
def test_one_read_feeds_three_stores_through_a_failure(spark, scratch):
    topic, store, ckpt = scratch("etl"), scratch("all"), scratch("ckpt")
    tables = P.store_tables(spark, store)
    tables["wide"] = X.LostOnce(tables["wide"], 1)
    arrivals = X.etl_arrivals(spark, SF_SMALL, ordered=True)
    X.feed(topic, arrivals, lambda: P.run([P.start_stores(spark, topic, store, ckpt, CITIES, tables=tables)]), only=[0])
    write_topic(arrivals[1], topic)
    with pytest.raises(Exception, match="the store is gone"):
        P.run([P.start_stores(spark, topic, store, ckpt, CITIES, tables=tables)])
    X.feed(topic, arrivals, lambda: P.run([P.start_stores(spark, topic, store, ckpt, CITIES)]), only=[2])
    held = P.store_tables(spark, store)
    cells = sorted((r["key"], r["field"], str(r["value"])) for r in held["cells"].read().collect())
    assert cells == sorted(tuple(r) for r in R.sets_to_cells(X.sets(spark, SF_SMALL)).select("key", "field", "value").collect())
    assert held["documents"].read().count() == X.etl_messages(spark, SF_SMALL).count()
    wide = latest_by_key(wide_rows(X.etl_messages(spark, SF_SMALL)), ["row_key"], ["position"]).drop("position")
    assert sorted(held["wide"].read().select(wide.columns).collect()) == sorted(wide.collect())


def test_added_sums_count_a_batch_once(spark, scratch):
    table = KeyedTable(spark, scratch("sums"), ["k"], mode="add", buckets=2)
    schema = "k string, n decimal(20,2)"
    one = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, n int").withColumn("n", F.col("n").cast("decimal(20,2)"))
    for batch_id in (0, 0, 1, 1):
        table.apply_batch(one, batch_id)
    assert sorted((r["k"], str(r["n"])) for r in table.read().collect()) == [("a", "8.00"), ("b", "4.00")]
    assert table.read().select("k", "n").schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()


# ---------------------------------------------------------------- quarantine (W5), intake caps
def test_quarantine_keeps_what_is_no_document(spark, scratch):
    topic, store, aside, ckpt = (scratch(n) for n in ("raw", "docs", "aside", "ckpt"))
    values = ['{"orderId":"1","ip":"a"}', None, "", "garbage", '{"ip":"b"}', "[1]", "{}", '{"orderId":"2"}', '{"orderId":"2","ip"', "null"]
    write_topic(spark.createDataFrame([(None, v, i) for i, v in enumerate(values)], "key string, value string, position long").coalesce(1), topic)
    P.run([P.start_documents(spark, topic, store, ckpt, quarantine=aside)])
    kept = P.Quarantine(P.document_table(spark, store), aside)
    why = {r["position"]: (r["value"], r["reason"]) for r in kept.rejected().collect()}
    assert {i: r for i, (_, r) in why.items()} == {1: "no value", 2: "empty", 3: "undecodable", 4: "no order id", 5: "undecodable", 6: "no order id",
                                                   8: "undecodable", 9: "undecodable"}
    assert all(v == values[i] for i, (v, _) in why.items())
    assert [tuple(r) for r in kept.counts().collect()] == [(0, 10, 2, 8)]
    # A replay replaces its own rows.
    judged = judge_document(read_topic(spark, topic), ("position",))
    kept(judged, 0)
    assert kept.rejected().count() == 8 and [tuple(r) for r in kept.counts().collect()] == [(0, 10, 2, 8)]
    assert sorted(r["orderId"] for r in kept.table.read().collect()) == ["1", "2"]


def test_intake_is_capped_under_a_backlog(spark, scratch):
    topic, store, aside = scratch("backlog"), scratch("docs"), scratch("aside")
    for i in range(5):
        write_topic(spark.createDataFrame([(None, json.dumps({"orderId": f"{i}-{j}"}), j) for j in range(i + 1)], "key string, value string, position long").coalesce(1), topic)
    P.run([P.start_documents(spark, topic, store, scratch("ckpt"), P.Topics(max_per_trigger=2), quarantine=aside)])
    counts = P.Quarantine(P.document_table(spark, store), aside).counts()
    assert sorted((r["batch"], r["read"]) for r in counts.collect()) == [(0, 3), (1, 7), (2, 5)]


# ---------------------------------------------------------------- interval jobs (S3)
def test_an_interval_job_takes_in_what_arrives_while_it_runs(spark, scratch):
    topic, store = scratch("wide"), scratch("store")
    schema = "key string, value string, position long"
    write_topic(spark.createDataFrame([put("1", "12", "t", 0, "a")], schema).coalesce(1), topic)
    query = P.start_wide_rows(spark, topic, store, scratch("ckpt"), trigger=P.Trigger(processing_time="1 second"))
    try:
        query.processAllAvailable()
        assert [r["orderId"] for r in P.wide_row_table(spark, store).read().collect()] == ["1"]
        write_topic(spark.createDataFrame([put("2", "12", "t", 1, "b")], schema).coalesce(1), topic)
        query.processAllAvailable()
        assert [r["orderId"] for r in P.wide_row_table(spark, store).read().collect()] == ["2"]
        assert query.isActive and len(query.recentProgress) >= 2
    finally:
        query.stop()


def test_report_state_does_not_follow_the_shuffle_partitions(spark, scratch):
    """A batch pays for every partition of the state; the reports' rows do not grow with the orders."""
    topic, ckpt, key = scratch("etl"), scratch("ckpt"), "spark.sql.shuffle.partitions"
    write_topic(X.etl_messages(spark, SF_SMALL), topic)
    before = spark.conf.get(key)
    spark.conf.set(key, "24")
    try:
        P.run(P.start_reports(spark, topic, scratch("kv"), ckpt, CITIES, which=("total",), query_suffix="-few"))
        P.run([P.start_reports_one_pass(spark, topic, scratch("cells"), f"{ckpt}/sets", CITIES, partitions=3)])
        P.run([P.start_bounded_daily(spark, topic, scratch("bounded"), f"{ckpt}/bounded")[0]])
        assert spark.conf.get(key) == "24"
    finally:
        spark.conf.set(key, before)
    for name, n in (("amt-total", P.STATE_PARTITIONS), ("sets", 3), ("bounded", P.STATE_PARTITIONS)):
        states = spark.read.format("state-metadata").load(f"{ckpt}/{name}").collect()
        assert states and {r["numPartitions"] for r in states} == {n}


def test_ordered_arrivals_take_their_bounds_from_the_staged_messages(spark, monkeypatch):
    """The messages are computed once: what is measured for the ranges has been staged."""
    measured, in_ranges = [], X.in_ranges
    monkeypatch.setattr(X, "in_ranges", lambda messages, *a: (measured.append(messages.inputFiles()), in_ranges(messages, *a))[1])
    arrivals = X.etl_arrivals(spark, SF_SMALL, ordered=True)
    assert measured and all("/arrivals-" in f for files in measured for f in files)
    ids = [[r["position"] for r in a.collect()] for a in arrivals]
    assert sorted(sum(ids, [])) == sorted(r["position"] for r in X.etl_messages(spark, SF_SMALL).collect())
    assert all(ids) and max(ids[0]) < min(ids[1]) and max(ids[1]) < min(ids[2])


def test_fold_with_the_table_carries_no_tie_break(spark):
    """Of a key's old and new row none are equal in age: without the tie-break the merge is the same."""
    rows = spark.createDataFrame(
        [(1, 0, "a", None), (1, 1, None, "b"), (2, 0, "c", "d"), (2, 1, "C", None), (None, 0, "n", None), (None, 1, "N", "m")],
        "k int, age int, x string, y string",
    )
    merged = [sorted(merge_by_key(rows, ["k"], ["age"], ["x", "y"], ties).collect(), key=str) for ties in (True, False)]
    assert merged[0] == merged[1] == sorted([(1, "a", "b"), (2, "C", "d"), (None, "N", "m")], key=str)
