"""Streaming jobs and the keyed tables they maintain."""

from tidemill.streaming.keyed import KeyedTable
from tidemill.streaming.pipeline import (
    AVAILABLE_NOW,
    Trigger,
    bounded_daily_total,
    run,
    start_bounded_daily,
    start_documents,
    start_etl,
    start_reports,
    start_wide_rows,
)

__all__ = [
    "AVAILABLE_NOW",
    "KeyedTable",
    "Trigger",
    "bounded_daily_total",
    "run",
    "start_bounded_daily",
    "start_documents",
    "start_etl",
    "start_reports",
    "start_wide_rows",
]
