"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Setup (untimed): the raw order topic and the enriched topic are written
once as Parquet topics in a fresh scratch folder, as a message bus would hold
them. Timed, median of 3 after one warm-up unless noted:

* flagship        raw topic -> ETL -> report parse -> daily sales by province
* flagship_tables the registered flagship query, message generation included
* ip_{range,prefix,shuffle}_{26,102k}  IP lookup with 26 and 102,400 ranges; range and prefix name the same bucket
                  join, shuffle is its salted form
* report_sets     the three reports in one grouping-sets pass from the enriched topic
* stream_reports  three update-mode report streams over the enriched topic (availableNow, once);
                  stream_reports_one_pass the same cells from one grouping-sets stream
* upsert_batch    one keyed upsert micro-batch (mean of 100), upsert_read the read after 100 batches
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill import prepare_session, scratch_path  # noqa: E402
from tidemill.operators import report as R  # noqa: E402
from tidemill.operators.etl import enriched_orders, etl_transform  # noqa: E402
from tidemill.operators.geo import build_dictionary  # noqa: E402
from tidemill.plans.catalog import QUERIES  # noqa: E402
from tidemill.sources.fixtures import CITIES, ip_dim, raw_messages  # noqa: E402
from tidemill.sources.tables import load_table  # noqa: E402
from tidemill.sources.topics import read_topic, write_topic  # noqa: E402
from tidemill.streaming import pipeline as P  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int = 3, warmup: int = 1) -> float:
    for _ in range(warmup):
        fn()
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def fine_dim(spark, sf_dir):
    """102,400 ranges: every /24 of each nation's /16 cut into 16 ranges of 16 addresses."""
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    base = F.lit(10).cast("bigint") * 16777216 + F.col("n_nationkey").cast("bigint") * 65536
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cut = nr.select(base.alias("b"), "r_name", "n_name", F.explode(F.sequence(F.lit(0), F.lit(4095))).alias("i"))
    return cut.select(
        (F.col("b") + F.col("i") * 16).alias("ip_lo"),
        (F.col("b") + F.col("i") * 16 + 15).alias("ip_hi"),
        F.concat(F.lit("X|0|"), F.col("r_name"), F.lit("|"), F.col("n_name"), F.lit("|isp")).alias("region"),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemill-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemill-bench-"))  # one machine: a folder of its own
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    # Scratch data goes under the session's checkpoint folder (a private one only if none is set).
    scratch = scratch_path(spark, "bench")

    # Untimed setup: topics as a message bus would hold them.
    raw_topic, etl_topic_path = f"{scratch}/topic-orders", f"{scratch}/topic-etl"
    # A topic with one partition per core, as a bus would hold it.
    parts = int(cpus)
    write_topic(raw_messages(spark, sf_dir), raw_topic, files=parts)
    # Dictionaries are built once, as a job would keep them.
    n_big = fine_dim(spark, sf_dir).count()
    dim, big = build_dictionary(ip_dim(spark, sf_dir)), build_dictionary(fine_dim(spark, sf_dir))
    write_topic(etl_transform(read_topic(spark, raw_topic), dim), etl_topic_path, files=parts)
    n_orders = load_table(spark, sf_dir, "orders").count()

    q: dict[str, float] = {}
    raw = read_topic(spark, raw_topic)
    etl = read_topic(spark, etl_topic_path)

    q["flagship"] = timed(lambda: run(R.daily_by_province(R.report_input(etl_transform(raw, dim)))))
    q["flagship_tables"] = timed(lambda: run(QUERIES["report_province"](spark, sf_dir)))
    for label, d in (("26", dim), (f"{n_big // 1000}k", big)):
        q[f"ip_prefix_{label}"] = timed(lambda d=d: run(enriched_orders(raw, d, "prefix")))
        q[f"ip_range_{label}"] = timed(lambda d=d: run(enriched_orders(raw, d, "range")))
        q[f"ip_shuffle_{label}"] = timed(lambda d=d: run(enriched_orders(raw, d, "shuffle")))
    q["report_sets"] = timed(lambda: run(R.sets_to_cells(R.daily_sets(R.report_input(etl), CITIES))))

    t0 = time.perf_counter()
    queries = P.start_reports(spark, etl_topic_path, f"{scratch}/kv", f"{scratch}/ckpt-reports", CITIES)
    P.run(queries)
    q["stream_reports"] = round(time.perf_counter() - t0, 3)
    n_etl = etl.count()
    throughput = {"stream_reports_rows_per_sec": round(n_etl / q["stream_reports"], 1)}
    t0 = time.perf_counter()
    P.run([P.start_reports_one_pass(spark, etl_topic_path, f"{scratch}/cells", f"{scratch}/ckpt-one", CITIES)])
    q["stream_reports_one_pass"] = round(time.perf_counter() - t0, 3)

    # Keyed upsert: 100 micro-batches of province cells (running totals), then one read.
    cells = R.daily_by_province(R.report_input(etl)).cache()
    cells.count()
    table = P.cell_table(spark, f"{scratch}/upsert")
    batch_times = []
    for b in range(100):
        slice_ = cells.filter(F.pmod(F.xxhash64("key", "field"), F.lit(100)) == b)
        t0 = time.perf_counter()
        table.apply_batch(slice_, b)
        batch_times.append(time.perf_counter() - t0)
    q["upsert_batch"] = round(statistics.mean(batch_times), 3)
    q["upsert_read"] = timed(lambda: run(table.read()))
    headline = q["flagship"]
    print(
        json.dumps(
            {
                "metric": "flagship_raw_json_to_daily_province_sales",
                "value": headline,
                "unit": "sec",
                "queries": q,
                "throughput": throughput,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "orders": n_orders,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
