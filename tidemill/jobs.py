"""The runnable jobs: ETL, reports, documents, wide rows, and the report export.

Each job is a function taking the caller's session and returning the started
streaming queries (or writing files, for the export); ``main`` wraps them in a
command line:

    python -m tidemill.jobs etl --source T1 --sink T2 --checkpoint C --ip-dim D
    python -m tidemill.jobs reports --source T2 --store S --checkpoint C [--three-streams]
    python -m tidemill.jobs documents --source T2 --store S --checkpoint C
    python -m tidemill.jobs wide-rows --source T2 --store S --checkpoint C [--every "5 seconds"]
    python -m tidemill.jobs export --store S --out O [--day 2024-01-01] [--csv O2] [--changes]

Topics are Parquet folders by default (``--format kafka --option
kafka.bootstrap.servers=...`` subscribes to a topic where the connector is
deployed; ``--sink-format`` and ``--sink-option`` are the same for the output). Without ``--every`` a job processes
what is available and stops.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators import report as R
from tidemill.operators.dictionary import normalised
from tidemill.schemas import IP_DIM
from tidemill.session import checkpoint_root, path_exists, prepare_session
from tidemill.sinks.files import write_report_csv, write_report_days, write_report_json
from tidemill.streaming import pipeline as P


_UPTO = "table string, batch long"


def _trigger(every: str | None) -> P.Trigger:
    return P.Trigger(processing_time=every) if every else P.AVAILABLE_NOW


def read_ip_dim(spark: SparkSession, path: str) -> DataFrame:
    """The IP dictionary table (ip_lo, ip_hi, region) from Parquet, its ranges made disjoint (the narrowest first)."""
    return normalised(spark.read.schema(IP_DIM).parquet(path))


def etl_job(
    spark, source, sink, checkpoint, ip_dim_path, every=None, topics=P.FILES, sink_format="parquet", sink_options=None
) -> list[StreamingQuery]:
    """Raw orders -> enriched orders (hop 1)."""
    dim = read_ip_dim(spark, ip_dim_path)
    trigger = _trigger(every)
    return [
        P.start_etl(spark, source, sink, checkpoint, dim, topics, trigger, sink_fmt=sink_format, sink_options=sink_options)
    ]


def reports_job(spark, source, store, checkpoint, cities=None, one_pass=True, every=None, topics=P.FILES, buckets=P.CELL_BUCKETS):
    """Daily totals, by province and by allow-listed city, kept in the hash store (hop 2).

    One grouping-sets stream by default; ``one_pass=False`` runs a stream for each report, as the reference does.
    """
    start = P.start_reports_one_pass if one_pass else P.start_reports
    started = start(
        spark, source, store, checkpoint, cities or R.REFERENCE_CITIES, topics, _trigger(every), buckets=buckets
    )
    return [started] if one_pass else started


def documents_job(spark, source, store, checkpoint, every=None, topics=P.FILES, buckets=P.BUCKETS, quarantine=None) -> list[StreamingQuery]:
    """Enriched orders merged into documents keyed by order id."""
    return [P.start_documents(spark, source, store, checkpoint, topics, _trigger(every), buckets, quarantine)]


def wide_rows_job(spark, source, store, checkpoint, every=None, topics=P.FILES, columns=None, buckets=P.BUCKETS) -> list[StreamingQuery]:
    """Enriched orders put as wide rows keyed by reverse(userId)_orderTime."""
    return [P.start_wide_rows(spark, source, store, checkpoint, topics, _trigger(every), columns, buckets)]


def store_cells(spark: SparkSession, store: str, one_pass: bool = True) -> DataFrame:
    """All current cells of a report store written by ``reports_job``; none if nothing was written yet."""
    out = spark.createDataFrame([], "key string, field string, value string")
    for table in _cell_tables(spark, store, one_pass).values():
        cells = table.read()
        if cells is not None:
            out = out.unionByName(cells.select("key", "field", "value"))
    return out


def export_report(spark, store, out, day=None, csv=None, one_pass=True) -> None:
    """The daily report documents (K5) and, optionally, the long table (K6), read from the store.

    A requested day always gives a document: total 0 and empty lists where it has no sales.
    """
    sets = R.cells_to_sets(store_cells(spark, store, one_pass))
    days = None
    if day:
        days = spark.createDataFrame([(day,)], "date string").select(F.col("date").cast("date").alias("date"))
        sets = sets.filter(F.col("order_date") == F.lit(day).cast("date"))
    write_report_json(R.report_document(sets, days), out)
    if csv:
        write_report_csv(R.report_long(sets), csv)


def _cell_tables(spark: SparkSession, store: str, one_pass: bool) -> dict:
    return {"cells": P.cell_table(spark, store)} if one_pass else P.report_tables(spark, store)


def exported_upto(spark: SparkSession, out: str) -> dict[str, int]:
    """Per report table the last batch that the export at ``out`` covers; empty before the first."""
    if not path_exists(spark, f"{out}/_upto"):
        return {}
    return {r["table"]: r["batch"] for r in spark.read.schema(_UPTO).parquet(f"{out}/_upto").collect()}  # a row a table


def export_changes(spark: SparkSession, store: str, out: str, one_pass: bool = True) -> DataFrame | None:
    """Bring the report documents at ``out`` up to date: only days with a cell written since the last export.

    A changed day's document is made from all of the day's cells, and takes
    the place of the day's folder. What the export covers is noted after
    that; an export that ends in between is repeated, with equal documents.
    Returns the days written, or None if nothing was new.
    """
    checkpoint_root(spark)
    before, after, changed = exported_upto(spark, out), {}, None
    tables = _cell_tables(spark, store, one_pass)
    for name, table in tables.items():
        rows, after[name] = table.changed_after(before.get(name, -1))
        if rows is not None:
            keys = rows.select("key", "field", "value")
            changed = keys if changed is None else changed.unionByName(keys)
    if changed is None:
        return None
    days = R.cells_to_sets(changed).select("order_date").distinct().checkpoint()
    sets = R.cells_to_sets(store_cells(spark, store, one_pass))
    part = sets.join(days.withColumnRenamed("order_date", "_day"), F.col("order_date").eqNullSafe(F.col("_day")), "left_semi")
    write_report_days(R.report_document(part), out)
    spark.createDataFrame(list(after.items()), _UPTO).coalesce(1).write.mode("overwrite").parquet(f"{out}/_upto")
    return days


def _options(pairs: list[str] | None) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs or [])


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemill.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    for name in ("etl", "reports", "documents", "wide-rows"):
        p = sub.add_parser(name)
        p.add_argument("--source", required=True)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--every", help="processing-time trigger, e.g. '5 seconds'; default: available now")
        if name == "documents":
            p.add_argument("--quarantine", help="folder for the messages that are no documents, with batch and reason")
        p.add_argument("--max-per-trigger", type=int, help="intake cap: files, or offsets with --format kafka")
        p.add_argument("--format", default="parquet", help="format of the source topic: parquet or kafka")
        p.add_argument("--option", action="append", metavar="NAME=VALUE", help="option of the source, may repeat")
        if name == "etl":
            p.add_argument("--sink", required=True)
            p.add_argument("--sink-format", default="parquet")
            p.add_argument("--sink-option", action="append", metavar="NAME=VALUE")
            p.add_argument("--ip-dim", required=True)
        else:
            p.add_argument("--store", required=True)
            few = P.CELL_BUCKETS if name == "reports" else P.BUCKETS
            p.add_argument("--buckets", type=int, default=few, help="key buckets of the store's tables, fixed by the first batch")
        if name == "reports":
            p.add_argument("--three-streams", action="store_true", help="a stream for each report")
            p.add_argument("--cities", help="comma-separated allow-list")
        if name == "wide-rows":
            p.add_argument("--columns", help="comma-separated cells of a row")
    e = sub.add_parser("export")
    e.add_argument("--store", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--csv")
    e.add_argument("--day")
    e.add_argument("--changes", action="store_true", help="write the days changed since the last such export, a folder each")
    e.add_argument("--three-streams", action="store_true")
    return parser


def _listed(text: str | None) -> list[str] | None:
    return text.split(",") if text else None


def start_job(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Start the streaming job the arguments name."""
    topics = P.Topics(args.format, _options(args.option), args.max_per_trigger)
    common = {"every": args.every, "topics": topics}
    if args.job == "etl":
        return etl_job(
            spark, args.source, args.sink, args.checkpoint, args.ip_dim, **common,
            sink_format=args.sink_format, sink_options=_options(args.sink_option),
        )
    if args.job == "reports":
        return reports_job(
            spark, args.source, args.store, args.checkpoint, _listed(args.cities), not args.three_streams, **common, buckets=args.buckets
        )
    if args.job == "documents":
        return documents_job(spark, args.source, args.store, args.checkpoint, **common, buckets=args.buckets, quarantine=args.quarantine)
    return wide_rows_job(
        spark, args.source, args.store, args.checkpoint, columns=_listed(args.columns), **common, buckets=args.buckets
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = prepare_session(SparkSession.builder.appName(f"tidemill-{args.job}").getOrCreate())
    if args.job == "export" and args.changes:
        export_changes(spark, args.store, args.out, not args.three_streams)
        return
    if args.job == "export":
        export_report(spark, args.store, args.out, args.day, args.csv, not args.three_streams)
        return
    P.run(start_job(spark, args))


if __name__ == "__main__":
    main()
