"""Shared helpers: reading tables, spooling intermediate tables, Arrow access to text."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import discard, shared_dir, spool

__all__ = ["ROWS", "ascii_lower", "discard", "each_batch", "read", "shared_dir", "short_batches", "slices", "small_reads", "spool", "text_of", "whole"]

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int):
    """Batches of few rows for what runs meanwhile: rows with large values need little memory then."""
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ROWS, before)


READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


@contextlib.contextmanager
def small_reads(spark: SparkSession, rows: int):
    """Parquet is read so many rows at a time by what runs meanwhile: a reader holds its 4096 rows' arrays whole otherwise."""
    before = spark.conf.get(READ_ROWS)
    spark.conf.set(READ_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(READ_ROWS, before)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the input folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def whole(df: DataFrame):
    """All columns of df in one struct, so that an operator's own columns can't clash with them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def text_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with nulls as empty strings."""
    return pc.fill_null(batch.column(name).cast(pa.string()), "")


def slices(texts: pa.Array, size: int = 1 << 17) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole rows of about ``size`` bytes.

    A longer row comes alone, whole.
    """
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        end = min(end, n)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def each_batch(make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]]):
    """A mapInArrow function from a factory that is called once in a task."""

    def run(batches):
        work = make()
        for batch in batches:
            yield from work(batch)

    return run
