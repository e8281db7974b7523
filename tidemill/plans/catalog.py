"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the supplied tables (or data Spark derives from them) in
full. Streaming queries run their jobs with ``availableNow`` into fresh
folders under the shared checkpoint root and return what the sink holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.casts import lenient_int, to_decimal_money
from tidemill.functions.ip import int_to_ip, ip_to_long
from tidemill.functions.json import json_field
from tidemill.functions.time import RECORD_PATTERN, millis_to_text, order_id_text, user_id_text
from tidemill.jobs import export_changes
from tidemill.operators import report as R
from tidemill.operators import stores as S
from tidemill.operators.clean import drop_junk, message_text, parse_raw_order
from tidemill.operators.dictionary import normalised
from tidemill.operators.etl import open_orders
from tidemill.operators.geo import locate, save_dictionary_table
from tidemill.operators.offsets import number_log, resume, save_offsets
from tidemill.operators.upsert import latest_by_key, merge_by_key
from tidemill.plans import scenarios as X
from tidemill.schemas import ORDER_FIELDS
from tidemill.session import scratch_path
from tidemill.sinks.files import read_report_csv, read_report_json, write_report_csv, write_report_json
from tidemill.sources.fixtures import CITIES, nested_ip_dim, raw_messages
from tidemill.sources.tables import load_table
from tidemill.sources.topics import read_topic
from tidemill.streaming import pipeline as P

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- ETL hop
def etl_clean(spark, sf_dir):
    """Messages kept by the junk filter; junk text shown where there is no order id."""
    X.start(spark)
    kept = drop_junk(message_text(raw_messages(spark, sf_dir)))
    order_id = json_field("value", "orderId")
    return kept.select(order_id.alias("orderId"), F.when(order_id.isNull(), F.col("value")).alias("junk"))


def etl_parse(spark, sf_dir):
    """The six parsed fields of every kept message."""
    X.start(spark)
    return parse_raw_order(drop_junk(message_text(raw_messages(spark, sf_dir))))


def etl_open_orders(spark, sf_dir):
    """Open orders only."""
    X.start(spark)
    return open_orders(parse_raw_order(drop_junk(message_text(raw_messages(spark, sf_dir)))))


def _located(strategy):
    def query(spark, sf_dir):
        X.start(spark)
        return X.enriched(spark, sf_dir, strategy).select("orderId", "ip", "province", "city")

    query.__doc__ = f"J1/J1b ({strategy}): open orders with province and city."
    return query


def etl_ip_stored_join(spark, sf_dir):
    """Open orders located through a dictionary stored as a bucketed table."""
    X.start(spark)
    path = scratch_path(spark, "dictionary-table")
    name = "ip_dictionary_" + path.rsplit("-", 1)[-1]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = save_dictionary_table(X.ip_dim(spark, sf_dir), name, path, parts)
    orders = open_orders(parse_raw_order(drop_junk(message_text(raw_messages(spark, sf_dir)))))
    return locate(orders, table).select("orderId", "ip", "province", "city")


def dictionary_normalised(spark, sf_dir):
    """A dictionary of nested and crossing ranges made disjoint, the narrowest range first."""
    X.start(spark)
    return normalised(nested_ip_dim(spark, sf_dir))


def etl_ip_nested(spark, sf_dir):
    """Open orders located through that dictionary."""
    X.start(spark)
    orders = open_orders(parse_raw_order(drop_junk(message_text(raw_messages(spark, sf_dir)))))
    return locate(orders, normalised(nested_ip_dim(spark, sf_dir))).select("orderId", "ip", "province", "city")


def etl_output_fields(spark, sf_dir):
    """The ETL output messages parsed back into their key and eight fields."""
    X.start(spark)
    return _parse_back(X.etl_messages(spark, sf_dir))


def _parse_back(msgs: DataFrame) -> DataFrame:
    return msgs.select("key", *[json_field("value", f).alias(f) for f in ORDER_FIELDS])


# ---------------------------------------------------------------- reports
def _cells(name):
    def query(spark, sf_dir):
        X.start(spark)
        return X.report_cells(spark, sf_dir, name)

    query.__doc__ = f"Daily report cells: {name}."
    return query


def report_city_semi(spark, sf_dir):
    """The city report with the allow-list as a table (left-semi join)."""
    X.start(spark)
    cities = spark.createDataFrame([(c,) for c in CITIES], "city string")
    return R.daily_by_city(X.report_rows(spark, sf_dir), city_table=cities)


def report_sets(spark, sf_dir):
    """A4: the three reports in one grouping-sets pass, as cells."""
    X.start(spark)
    return R.sets_to_cells(X.sets(spark, sf_dir))


def report_long(spark, sf_dir):
    """A5 K6: long table (date, dimension, category, sales)."""
    X.start(spark)
    return R.report_long(X.sets(spark, sf_dir))


def report_document(spark, sf_dir):
    """Nested daily document, lists spelled out for comparison."""
    X.start(spark)
    return R.flatten_document(R.report_document(X.sets(spark, sf_dir)))


def report_day_default(spark, sf_dir):
    """Documents of requested days, one for a day without sales too (total 0, empty lists)."""
    X.start(spark)
    sets = X.sets(spark, sf_dir)
    ends = sets.agg(F.date_sub(F.min("order_date"), 2).alias("lo"), F.date_add(F.max("order_date"), 2).alias("hi"))
    days = ends.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return R.flatten_document(R.report_document(sets, days))


def report_series(spark, sf_dir):
    """Chart series per day."""
    X.start(spark)
    return R.report_series(R.report_document(X.sets(spark, sf_dir)))


def report_json_file(spark, sf_dir):
    """K5: the daily documents written as JSON and read back (lists spelled out)."""
    X.start(spark)
    path = scratch_path(spark, "report-json")
    write_report_json(R.report_document(X.sets(spark, sf_dir)), path)
    return R.flatten_document(read_report_json(spark, path))


def report_csv_file(spark, sf_dir):
    """K6: the long report written as CSV with a header and read back."""
    X.start(spark)
    path = scratch_path(spark, "report-csv")
    write_report_csv(R.report_long(X.sets(spark, sf_dir)), path)
    return read_report_csv(spark, path)


# ---------------------------------------------------------------- stores in batch
def store_kv_latest(spark, sf_dir):
    """The hash store after three micro-batches of running totals."""
    X.start(spark)
    return X.kv_store(spark, sf_dir)


def store_kv_get(spark, sf_dir):
    """The daily total for every day in the order-date range; missing days read '0'."""
    X.start(spark)
    store = X.kv_tables(spark, sf_dir)
    days = X.date_spine(X.report_rows(spark, sf_dir).filter(F.col("order_date").isNotNull()))
    requests = days.select(
        F.concat_ws(":", F.lit(R.PREFIX_TOTAL), F.col("order_date").cast("string")).alias("key"),
        F.lit(R.FIELD_GLOBAL).alias("field"),
    )
    return S.kv_get(P.report_tables(spark, store)["total"].read_for(requests), requests)


def store_kv_getall(spark, sf_dir):
    """Every hash read whole (key -> fields), spelled out as sorted field=value pairs."""
    X.start(spark)
    hashes = S.kv_hashes(X.kv_store(spark, sf_dir))
    entries = F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return hashes.select("key", F.size("fields").alias("n_fields"), F.array_join(entries, ";").alias("entries"))


def report_from_store(spark, sf_dir):
    """The daily documents rebuilt from the hash store's cells, as the export reads them."""
    X.start(spark)
    return R.flatten_document(R.report_document(R.cells_to_sets(X.kv_store(spark, sf_dir))))


def store_wide_rows(spark, sf_dir):
    """Wide rows of every enriched message."""
    X.start(spark)
    return S.wide_rows(X.etl_messages(spark, sf_dir)).drop("position")


def store_wide_custom(spark, sf_dir):
    """P10 K4: wide rows of a chosen column list, put in write order."""
    X.start(spark)
    rows = S.wide_rows(X.etl_messages(spark, sf_dir), columns=["ip", "city"])
    return latest_by_key(rows, ["row_key"], ["position"]).drop("position")


def store_wide_latest(spark, sf_dir):
    """Wide rows after the puts; same user + same time overwrite, in write order."""
    X.start(spark)
    rows = S.wide_rows(X.etl_messages(spark, sf_dir))
    return latest_by_key(rows, ["row_key"], ["position"]).drop("position")


def store_documents(spark, sf_dir):
    """Typed documents of every enriched message."""
    X.start(spark)
    return S.documents(X.etl_messages(spark, sf_dir)).drop("position")


def store_documents_merged(spark, sf_dir):
    """Documents merged field by field (a NULL never overwrites), three versions per order."""
    X.start(spark)
    docs = S.documents(X.order_versions(spark, sf_dir))
    return merge_by_key(docs, ["orderId"], ["position"], [f for f in ORDER_FIELDS if f != "orderId"])


# ---------------------------------------------------------------- streaming
# Each streaming query is fed its input in three arrivals; after each arrival the
# query runs once with availableNow from its checkpoint (so every run is a restart).


def stream_etl(spark, sf_dir):
    """Hop 1 as a stream; the enriched topic parsed back."""
    X.start(spark)
    source, out, ckpt = (scratch_path(spark, n) for n in ("topic-orders", "topic-etl", "ckpt-etl"))
    dim = X.ip_dim(spark, sf_dir)
    X.feed(source, X.raw_arrivals(spark, sf_dir), lambda: P.run([P.start_etl(spark, source, out, ckpt, dim)]))
    return _parse_back(read_topic(spark, out))


def _suffix(path: str) -> str:
    return "-" + path.rsplit("-", 1)[-1]


def _stream_report(name):
    def query(spark, sf_dir):
        X.start(spark)
        topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-etl", "store-kv", "ckpt-report"))

        def run_once():
            P.run(P.start_reports(spark, topic, store, ckpt, CITIES, which=(name,), query_suffix=_suffix(store)))

        X.feed(topic, X.etl_arrivals(spark, sf_dir), run_once)
        return P.report_tables(spark, store)[name].read()

    query.__doc__ = f"S2 T2 T3 T6 U3: the {name} report as an update-mode stream into the hash store."
    return query


def _both_hops(spark, sf_dir, source, etl, store, ckpt):
    dim = X.ip_dim(spark, sf_dir)

    def run_once():
        P.run([P.start_etl(spark, source, etl, f"{ckpt}/etl", dim)])
        P.run(P.start_reports(spark, etl, store, f"{ckpt}/reports", CITIES, query_suffix=_suffix(store)))

    return run_once


def stream_two_hop(spark, sf_dir):
    """Raw topic -> ETL stream -> enriched topic -> three report streams; the province hash."""
    X.start(spark)
    source, etl, store, ckpt = (scratch_path(spark, n) for n in ("topic-orders", "topic-etl", "store-kv", "ckpt"))
    X.feed(source, X.raw_arrivals(spark, sf_dir), _both_hops(spark, sf_dir, source, etl, store, ckpt))
    return P.report_tables(spark, store)["province"].read()


def stream_restart(spark, sf_dir):
    """Both hops run over two arrivals at once, again after the third, and once more with
    nothing new; equals one pass over everything."""
    X.start(spark)
    source, etl, store, ckpt = (scratch_path(spark, n) for n in ("topic-orders", "topic-etl", "store-kv", "ckpt"))
    run_once = _both_hops(spark, sf_dir, source, etl, store, ckpt)
    arrivals = X.raw_arrivals(spark, sf_dir)
    X.feed(source, arrivals, lambda: None, only=[0])
    X.feed(source, arrivals, run_once, only=[1])
    X.feed(source, arrivals, run_once, only=[2])
    run_once()
    return P.report_tables(spark, store)["province"].read()


def stream_sets(spark, sf_dir):
    """The three reports as ONE update-mode stream (one read, one state, consistent cells)."""
    X.start(spark)
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-etl", "store-cells", "ckpt-sets"))
    X.feed(topic, X.etl_arrivals(spark, sf_dir),
           lambda: P.run([P.start_reports_one_pass(spark, topic, store, ckpt, CITIES)]))
    return P.cell_table(spark, store).read()


def stream_wide(spark, sf_dir):
    """Wide rows upserted per micro-batch."""
    X.start(spark)
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-etl", "store-wide", "ckpt-wide"))
    run_once = lambda: P.run([P.start_wide_rows(spark, topic, store, ckpt)])
    X.feed(topic, X.etl_arrivals(spark, sf_dir, ordered=True), run_once)
    return P.wide_row_table(spark, store).read()


def stream_documents(spark, sf_dir):
    """Documents merged per micro-batch, several versions of an order inside one."""
    X.start(spark)
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-etl", "store-docs", "ckpt-docs"))

    X.feed(topic, X.version_arrivals(spark, sf_dir), lambda: P.run([P.start_documents(spark, topic, store, ckpt)]))
    return P.document_table(spark, store).read()


def stream_daily_bounded(spark, sf_dir):
    """T4 T5: daily totals on an event-time window with a watermark, over purchase events."""
    X.start(spark)
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-events", "store-bounded", "ckpt-bounded"))
    X.feed(topic, X.event_arrivals(spark, sf_dir), lambda: P.run([P.start_bounded_daily(spark, topic, store, ckpt)[0]]))
    table = P.bounded_table(spark, store)
    return table.read().select("order_date", F.col("total_amt").cast("decimal(20,2)").alias("total_amt"))


def stream_wide_state(spark, sf_dir):
    """The latest wide row of each key as streaming state, from arrivals in no order."""
    X.start(spark)
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-etl", "store-wide", "ckpt-wide"))
    X.feed(topic, X.etl_arrivals(spark, sf_dir), lambda: P.run([P.start_wide_rows_state(spark, topic, store, ckpt)]))
    return P.wide_state_table(spark, store).read()


def stream_state_rows(spark, sf_dir):
    """Rows, first and last day of the state after every micro-batch, parity and bounded form, read from the state store.

    Each arrival makes two batches: its rows, then one without rows that moves the watermark on.
    """
    X.start(spark)
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-events", "store-state", "ckpt-state"))

    def run_once():
        P.run([P.start_bounded_daily(spark, topic, f"{store}/bounded", f"{ckpt}/bounded")[0]])
        P.run(P.start_reports(spark, topic, f"{store}/kv", ckpt, CITIES, which=("total",), query_suffix=_suffix(store)))

    X.feed(topic, X.event_arrivals(spark, sf_dir), run_once)
    out = None
    for form, path, day in (("parity", f"{ckpt}/amt-total", "key.order_date"), ("bounded", f"{ckpt}/bounded", "key.window.start")):
        for batch in range(P.last_state_batch(spark, path) + 1):
            state = P.state_table(spark, path, batch).select(F.col(day).cast("date").alias("day"))
            rows = state.agg(F.count("*").alias("state_rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
            rows = rows.select(F.lit(form).alias("form"), F.lit(batch).alias("batch"), "*")
            out = rows if out is None else out.unionByName(rows)
    return out


def stream_late_rows(spark, sf_dir):
    """T5: rows each micro-batch of the bounded form keeps and drops, by the running watermark."""
    X.start(spark)
    return P.late_by_batch(X.event_batches(spark, sf_dir), "batch", "order_timestamp")


def stream_stores(spark, sf_dir):
    """One stream feeds cells, documents and wide rows; it fails between two stores and goes on."""
    X.start(spark)
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic-etl", "store-all", "ckpt-all"))
    tables = P.store_tables(spark, store)
    tables["documents"] = X.LostOnce(tables["documents"], 1)

    def run_once():
        try:
            P.run([P.start_stores(spark, topic, store, ckpt, CITIES, tables=tables)])
        except StreamingQueryException:
            P.run([P.start_stores(spark, topic, store, ckpt, CITIES)])

    X.feed(topic, X.etl_arrivals(spark, sf_dir, ordered=True), run_once)
    held = {name: table.read() for name, table in P.store_tables(spark, store).items()}
    cells = held["cells"].select(F.lit("cells").alias("store"), "key", "field", F.col("value").cast("string").alias("value"))
    docs = X.cells_of(held["documents"], "documents", "orderId", ORDER_FIELDS)
    return cells.unionByName(docs).unionByName(X.cells_of(held["wide"], "wide", "row_key", ORDER_FIELDS))


def stream_quarantine(spark, sf_dir):
    """Per micro-batch, messages read, kept as documents, and rejected by reason."""
    X.start(spark)
    topic, store, ckpt, aside = (scratch_path(spark, n) for n in ("topic-raw", "store-docs", "ckpt-docs", "quarantine"))
    X.feed(topic, X.damaged_arrivals(spark, sf_dir), lambda: P.run([P.start_documents(spark, topic, store, ckpt, quarantine=aside)]))
    kept_aside = P.Quarantine(P.document_table(spark, store), aside)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("outcome"), F.col(c).alias("messages")) for c in ("read", "kept")]))
    counts = kept_aside.counts().select("batch", pairs.alias("p")).select("batch", "p.outcome", "p.messages")
    return counts.unionByName(kept_aside.rejected().groupBy("batch", F.col("reason").alias("outcome")).agg(F.count("*").alias("messages")))


def stream_intake(spark, sf_dir):
    """A backlog of eight files taken in three at a time; messages of every micro-batch, as the sink counted them."""
    X.start(spark)
    topic, store, ckpt, aside = (scratch_path(spark, n) for n in ("topic-etl", "store-docs", "ckpt-docs", "quarantine"))
    X.backlog(spark, sf_dir, topic)
    P.run([P.start_documents(spark, topic, store, ckpt, P.Topics(max_per_trigger=X.FILES_A_BATCH), quarantine=aside)])
    return P.Quarantine(P.document_table(spark, store), aside).counts().select("batch", F.col("read").alias("messages"))


def report_export_changes(spark, sf_dir):
    """The report documents after an export for each arrival, each writing the days that changed."""
    X.start(spark)
    topic, store, ckpt, out = (scratch_path(spark, n) for n in ("topic-etl", "store-cells", "ckpt-sets", "report-days"))

    def run_once():
        P.run([P.start_reports_one_pass(spark, topic, store, ckpt, CITIES)])
        export_changes(spark, store, out)

    X.feed(topic, X.day_arrivals(spark, sf_dir), run_once)
    return R.flatten_document(read_report_json(spark, out))


# ---------------------------------------------------------------- scalar functions
def scalar_ip_text(spark, sf_dir):
    """A signed 32-bit address per order -> dotted text -> unsigned number."""
    X.start(spark)
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    signed = F.pmod(F.col("o_orderkey") * F.lit(65537) + F.col("o_custkey"), F.lit(4294967296)) - F.lit(2147483648)
    with_ip = orders.select("o_orderkey", signed.alias("ip_signed"))
    text = with_ip.withColumn("ip_text", int_to_ip("ip_signed"))
    return text.withColumn("ip_number", ip_to_long("ip_text"))


def scalar_date_text(spark, sf_dir):
    """event time as epoch millis and the two producer text formats."""
    X.start(spark)
    events = load_table(spark, sf_dir, "events").select("event_id", "ts")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    with_ms = events.select("event_id", millis.alias("millis"))
    return with_ms.select(
        "event_id", "millis", millis_to_text("millis").alias("compact"),
        millis_to_text("millis", RECORD_PATTERN).alias("record"),
    )


def scalar_ids(spark, sf_dir):
    """F16: producer-style order ids (time + 6-digit sequence) and user ids (digit + 8 digits)."""
    X.start(spark)
    events = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        "event_id",
        order_id_text(millis, F.pmod("event_id", F.lit(1000000))).alias("order_id"),
        user_id_text(F.lit(1) + F.pmod("user_id", F.lit(5)), "user_id").alias("user_id"),
    )


def scalar_json_props(spark, sf_dir):
    """JSON path on event props, lenient int, money as decimal(10,2)."""
    X.start(spark)
    events = load_table(spark, sf_dir, "events").select("event_id", "props", "value")
    k = json_field("props", "k")
    return events.select(
        "event_id", k.alias("k_text"), lenient_int(k).alias("k"), to_decimal_money(F.col("value")).alias("money")
    )


# ---------------------------------------------------------------- offset ledger
def _event_log(spark, sf_dir) -> DataFrame:
    events = load_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    parts = events.select("event_id", "ts", F.pmod("user_id", F.lit(3)).cast("int").alias("partition"))
    return number_log(parts, "events", "partition", "event_id")


# Fixture: the first run consumed partitions 0 and 1 up to this time; partition 2 never.
FIRST_RUN_UNTIL = "2024-01-08 00:00:00"


def _first_ledger(log: DataFrame) -> DataFrame:
    consumed = log.filter(
        (F.col("ts") < F.lit(FIRST_RUN_UNTIL).cast("timestamp_ntz")) & (F.col("partition") != 2)
    )
    empty = log.limit(0).select("topic", "partition", F.lit(0).cast("bigint").alias("from_offset"))
    return save_offsets(empty, consumed)


def offsets_resume(spark, sf_dir):
    """Records still to read after the first run; an unrecorded partition starts at 0."""
    X.start(spark)
    log = _event_log(spark, sf_dir)
    return resume(log, _first_ledger(log)).select("topic", "partition", "offset", "event_id")


def offsets_commit(spark, sf_dir):
    """R2: the ledger after the second run commits everything it resumed."""
    X.start(spark)
    log = _event_log(spark, sf_dir)
    ledger = _first_ledger(log).checkpoint(eager=True)  # used twice: compute once
    return save_offsets(ledger, resume(log, ledger))


QUERIES: dict[str, Query] = {
    "etl_clean": etl_clean,
    "etl_parse": etl_parse,
    "etl_open_orders": etl_open_orders,
    "etl_ip_range_join": _located("range"),
    "etl_ip_prefix_join": _located("prefix"),
    "etl_ip_salted_join": _located("shuffle"),
    "etl_ip_stored_join": etl_ip_stored_join,
    "dictionary_normalised": dictionary_normalised,
    "etl_ip_nested": etl_ip_nested,
    "etl_output_fields": etl_output_fields,
    "report_total": _cells("total"),
    "report_province": _cells("province"),
    "report_city": _cells("city"),
    "report_city_semi": report_city_semi,
    "report_sets": report_sets,
    "report_long": report_long,
    "report_document": report_document,
    "report_day_default": report_day_default,
    "report_series": report_series,
    "report_json_file": report_json_file,
    "report_csv_file": report_csv_file,
    "store_kv_latest": store_kv_latest,
    "store_kv_get": store_kv_get,
    "store_kv_getall": store_kv_getall,
    "report_from_store": report_from_store,
    "store_wide_rows": store_wide_rows,
    "store_wide_latest": store_wide_latest,
    "store_wide_custom": store_wide_custom,
    "store_documents": store_documents,
    "store_documents_merged": store_documents_merged,
    "stream_etl": stream_etl,
    "stream_total": _stream_report("total"),
    "stream_province": _stream_report("province"),
    "stream_city": _stream_report("city"),
    "stream_two_hop": stream_two_hop,
    "stream_restart": stream_restart,
    "stream_sets": stream_sets,
    "stream_wide": stream_wide,
    "stream_documents": stream_documents,
    "stream_daily_bounded": stream_daily_bounded,
    "stream_wide_state": stream_wide_state,
    "stream_state_rows": stream_state_rows,
    "stream_late_rows": stream_late_rows,
    "stream_stores": stream_stores,
    "stream_quarantine": stream_quarantine,
    "stream_intake": stream_intake,
    "report_export_changes": report_export_changes,
    "scalar_ip_text": scalar_ip_text,
    "scalar_date_text": scalar_date_text,
    "scalar_ids": scalar_ids,
    "scalar_json_props": scalar_json_props,
    "offsets_resume": offsets_resume,
    "offsets_commit": offsets_commit,
}
