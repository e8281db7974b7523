"""File sinks for the reports (K5, K6); topic and keyed-table sinks live in sources/ and streaming/."""

from tidemill.sinks.files import read_report_csv, read_report_json, write_report_csv, write_report_json

__all__ = ["read_report_csv", "read_report_json", "write_report_csv", "write_report_json"]
