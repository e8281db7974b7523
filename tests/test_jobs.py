"""The runnable jobs end to end: ETL -> reports -> export, documents, wide rows."""

from __future__ import annotations

import glob
import os

from tests.conftest import SF_SMALL
from tidemill import jobs
from tidemill.operators import report as R
from tidemill.plans import scenarios as X
from tidemill.sinks.files import read_report_json
from tidemill.sources.fixtures import CITIES, ip_dim
from tidemill.sources.topics import write_topic
from tidemill.streaming import pipeline as P


def test_jobs_end_to_end(spark, scratch):
    dim_path, raw, etl, store, ckpt, out = (scratch(n) for n in ("dim", "raw", "etl", "kv", "ckpt", "report"))
    ip_dim(spark, SF_SMALL).write.parquet(dim_path)
    write_topic(X.raw_arrivals(spark, SF_SMALL)[0], raw)
    write_topic(X.raw_arrivals(spark, SF_SMALL)[1], raw)
    write_topic(X.raw_arrivals(spark, SF_SMALL)[2], raw)
    P.run(jobs.etl_job(spark, raw, etl, f"{ckpt}/etl", dim_path))
    P.run(jobs.reports_job(spark, etl, store, f"{ckpt}/rep", CITIES))
    P.run(jobs.documents_job(spark, etl, f"{store}-docs", f"{ckpt}/docs"))
    P.run(jobs.wide_rows_job(spark, etl, f"{store}-wide", f"{ckpt}/wide"))
    jobs.export_report(spark, store, out)

    want = R.flatten_document(R.report_document(X.sets(spark, SF_SMALL)))
    got = R.flatten_document(read_report_json(spark, out))
    assert sorted(got.collect()) == sorted(want.collect())
    assert P.document_table(spark, f"{store}-docs").read().count() == X.etl_messages(spark, SF_SMALL).count()
    assert P.wide_row_table(spark, f"{store}-wide").read().count() > 0


def test_cells_round_trip_to_sets(spark):
    rows = X.report_rows(spark, SF_SMALL)
    sets = R.daily_sets(rows, CITIES)
    back = R.cells_to_sets(R.sets_to_cells(sets).drop("grain"))
    assert sorted(back.collect()) == sorted(sets.collect())


def test_command_line(spark, scratch):
    dim_path, raw, etl, store, ckpt, out = (scratch(n) for n in ("dim", "raw", "etl", "kv", "ckpt", "report"))
    ip_dim(spark, SF_SMALL).write.parquet(dim_path)
    write_topic(X.raw_arrivals(spark, SF_SMALL)[0], raw)
    jobs.main(["etl", "--source", raw, "--sink", etl, "--checkpoint", f"{ckpt}/etl", "--ip-dim", dim_path])
    jobs.main(["reports", "--source", etl, "--store", store, "--checkpoint", f"{ckpt}/rep", "--cities", ",".join(CITIES)])
    jobs.main(["export", "--store", store, "--out", out, "--csv", f"{out}-csv"])
    assert read_report_json(spark, out).count() > 0


def test_export_of_a_day_without_sales_and_of_an_empty_store(spark, scratch):
    for one_pass in (True, False):
        out = scratch("report")
        jobs.export_report(spark, scratch("nothing"), out, day="2024-01-01", csv=f"{out}-csv", one_pass=one_pass)
        (doc,) = read_report_json(spark, out).collect()
        assert (str(doc["date"]), str(doc["total_sales"]), doc["province_sales"], doc["city_sales"]) == ("2024-01-01", "0.00", [], [])
        jobs.export_report(spark, scratch("nothing"), f"{out}-all", one_pass=one_pass)
        assert read_report_json(spark, f"{out}-all").count() == 0


def folders(path):
    """Write time of every day's folder of an export by day."""
    files = glob.glob(f"{path.removeprefix('file:')}/date=*/*.json")
    return {f.split("date=")[1].split("/")[0]: os.stat(f).st_mtime_ns for f in files}


def test_export_of_changed_days_only(spark, scratch):
    store, out = scratch("kv"), scratch("report")
    table, cells = P.cell_table(spark, store), "grain string, key string, field string, value string"
    day = lambda d, total, province: [("total", f"orders:money:total:{d}", "global", total), ("province", f"orders:money:province:{d}", "P", province)]
    assert jobs.export_changes(spark, store, out) is None
    table.apply_batch(spark.createDataFrame(day("2024-01-01", "1.00", "1.00") + day("2024-01-02", "2.00", "2.00"), cells), 0)
    assert jobs.export_changes(spark, store, out).count() == 2
    first = folders(out)
    table.apply_batch(spark.createDataFrame(day("2024-01-02", "5.00", "3.00")[:1] + day("2024-01-03", "7.00", "7.00"), cells), 1)
    assert sorted(str(r["order_date"]) for r in jobs.export_changes(spark, store, out).collect()) == ["2024-01-02", "2024-01-03"]
    second = folders(out)
    assert set(second) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert second["2024-01-01"] == first["2024-01-01"] and second["2024-01-02"] != first["2024-01-02"]
    full = scratch("full")
    jobs.export_report(spark, store, full)
    as_rows = lambda p: sorted(R.flatten_document(read_report_json(spark, p)).collect())
    assert as_rows(out) == as_rows(full) and len(as_rows(full)) == 3
    assert jobs.export_changes(spark, store, out) is None and folders(out) == second
    jobs.main(["export", "--store", store, "--out", out, "--changes"])
    assert jobs.exported_upto(spark, out) == {"cells": 1}


def test_job_options_reach_the_streams(spark, monkeypatch):
    """Source and sink formats, their options, the intake cap and the column list are passed through (no broker here)."""
    seen = {}
    for name in ("start_etl", "start_documents", "start_wide_rows", "start_reports_one_pass"):
        monkeypatch.setattr(P, name, lambda *a, _n=name, **k: seen.setdefault(_n, (a, k)))
    monkeypatch.setattr(jobs, "read_ip_dim", lambda *_: None)
    source = ["--source", "t", "--checkpoint", "c", "--format", "kafka", "--option", "kafka.bootstrap.servers=h:1", "--max-per-trigger", "7"]
    parse = lambda *a: jobs.arguments().parse_args([*a, *source])
    jobs.start_job(spark, parse("etl", "--sink", "o", "--ip-dim", "d", "--sink-format", "kafka", "--sink-option", "x=y"))
    jobs.start_job(spark, parse("documents", "--store", "s"))
    jobs.start_job(spark, parse("wide-rows", "--store", "s", "--columns", "ip,city"))
    jobs.start_job(spark, parse("reports", "--store", "s"))
    topics = P.Topics("kafka", {"kafka.bootstrap.servers": "h:1"}, 7)
    assert all(topics in a for a, _ in seen.values()) and len(seen) == 4
    assert seen["start_etl"][1] == {"sink_fmt": "kafka", "sink_options": {"x": "y"}}
    assert ["ip", "city"] in seen["start_wide_rows"][0]
