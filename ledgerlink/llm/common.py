"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ledgerlink.sources.store import stored

#: Bytes that one Arrow batch between Spark and Python holds, about; a single longer row is its own batch.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT = f"{64 << 20}b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(frame: DataFrame, function, schema: str) -> DataFrame:
    """`mapInArrow` whose batches are bounded in bytes as well as in rows, so that long texts fit.

    When a task ends, its worker empties its memories of words and gives back what is free, as workers
    stay for other tasks and other operators.
    """
    conf = frame.sparkSession.conf
    if conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:  # a setting of the user's own stays
        conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")

    def run(batches):
        try:
            yield from function(batches)
        finally:
            _give_back()

    return frame.mapInArrow(run, schema)


_FORGET: list = []


def at_task_end(forget) -> None:
    """Have `forget()` called in this worker at the end of each task; for memories that only save time."""
    _FORGET.append(forget)


def _give_back() -> None:
    for forget in _FORGET:
        forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def partitions_for(frame: DataFrame, size: int) -> int:
    """Partitions of about `size` bytes of the frame's input as it is stored, and no fewer than the session's."""
    stored_bytes = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # An unknown size is said to be immense.
    return max(least, -(-stored_bytes // size)) if stored_bytes < 1 << 60 else least


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about `size` bytes in `column`, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        part = np.cumsum(np.asarray(lengths, dtype=np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, end - start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column with null as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


__all__ = ["arrow_map", "at_task_end", "fresh", "partitions_for", "slices", "stored", "table", "texts"]
