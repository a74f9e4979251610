"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstats.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of texts that a task turns into Python strings at a time.
SLICE = 2_000_000
#: Rows that may be broadcast after they were counted; times the row width this stays in the low MB.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(c, UPPER, LOWER)


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their task and serve the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not a GNU C library
        pass


def gives_back(task: Callable[[Iterator], Iterator], *forget: Callable[[], None]) -> Callable[[Iterator], Iterator]:
    """``task`` over batches; at its end it calls ``forget`` and returns the worker's freed memory."""
    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            for f in forget:
                f()
            give_back()

    return run


def parts_of(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of which the texts or bytes in ``column`` take about ``most`` bytes, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = (np.flatnonzero(np.diff(ends // most)) + 1).tolist()
    for at, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(at, end - at)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A 64-bit key of a row's id and text, so that rows that repeat an id with another text stay apart."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def shuffled(df: DataFrame) -> DataFrame:
    """Mark ``df`` so that a join with it shuffles both sides, whatever size Spark expects.

    Spark broadcasts by an expected size, which is too low by far after an
    explode, whose rows it counts as one each, and for files in which values
    repeat. Adaptive execution keeps such a broadcast, as leaving it takes one
    more shuffle.
    """
    return df.hint("merge")


def broadcast_or_shuffled(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df``, of at most ``rows`` rows, for broadcast up to ``limit`` rows, and as ``shuffled`` beyond."""
    return F.broadcast(df) if rows <= limit else shuffled(df)


def small_or_shuffled(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when a count proves it to be at most ``limit`` rows.

    Use it on narrow, written tables only. Beyond the bound the join shuffles
    both sides, and adaptive execution splits its skewed partitions.
    """
    return broadcast_or_shuffled(df, df.limit(limit + 1).count(), limit)


def from_files(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself when its rows carry file metadata, else a written copy that does."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index").schema
        return df
    except AnalysisException:
        return materialize(df, name)
