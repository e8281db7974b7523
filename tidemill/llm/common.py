"""Shared helpers of the training-data operators: columns, words, scratch tables, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import prepare_session, scratch_path
from tidemill.sources.tables import load_table

#: Rows and bytes of an Arrow batch handed to Python, set where the session has the built-in row default.
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
BATCH_BYTES_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "16m"
#: A run of characters that are not ASCII white space is a word.
SPACES = r"[\x20\x09-\x0D]+"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: UTC, AQE where unset, Arrow batches of a bounded size."""
    prepare_session(spark)
    if spark.conf.get(BATCH_KEY) == "10000":  # the built-in default, meant for narrow rows
        spark.conf.set(BATCH_KEY, BATCH_ROWS)
        spark.conf.set(BATCH_BYTES_KEY, BATCH_BYTES)
    return spark


def open_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a supplied table, in a prepared session."""
    return load_table(prepared(spark), sf_dir, name).select(*columns)


def words_of(text: Column | str) -> Column:
    """Array of the words of a text, in order; null and empty texts have none."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), SPACES, -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it.

    A lambda body that mentions an outer expression evaluates it for each
    element; binding it as the element of a one-element array does not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: dict[str, dict] = {}


def kept(module: str) -> dict:
    """What the tasks of ``module`` keep in this Python worker for the next ones."""
    forget_others(module)
    return _KEPT.setdefault(module, {})


def forget_others(module: str) -> None:
    """Drop what other modules' tasks have kept: a worker serves one operator after another, and needs the last one's only."""
    for other in [m for m in _KEPT if m != module]:
        del _KEPT[other]


def hand_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed array memory otherwise
    if trim is not None:
        trim(0)


def released(run):
    """``run`` over batches, without what other operators have left in the worker; afterwards the worker, which lives on for other tasks, hands its freed memory back."""
    module = run.__module__

    def wrapped(batches):
        forget_others(module)
        yield from run(batches)
        hand_back()

    return wrapped


def text_slices(texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array with about ``max_bytes`` of text each, one row at least."""
    import numpy as np

    n = len(texts)
    if n == 0:
        return
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + max_bytes, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column as a plain string array, nulls as empty texts."""
    import pyarrow.compute as pc

    return pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.string()), "")
