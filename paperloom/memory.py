"""Memory of Python workers: bounded batches, and freed memory that goes back to the system."""

from __future__ import annotations

import ctypes
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import SparkSession

# Settings of the C library's mallopt (fixed numbers of its interface).
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound Arrow batches by rows and by bytes, so that a Python worker never holds more than one small batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


@lru_cache(maxsize=1)
def _libc():
    try:
        return ctypes.CDLL(None)
    except OSError:
        return None


@lru_cache(maxsize=1)
def _sparing() -> None:
    """Let this process hold little memory that it has freed: large blocks apart, Arrow without a pool of its own."""
    pa.set_memory_pool(pa.system_memory_pool())
    tune = getattr(_libc(), "mallopt", None)
    if tune is not None:
        for setting in (_TRIM_THRESHOLD, _MMAP_THRESHOLD):
            tune(setting, 1 << 20)


def give_back() -> None:
    """Return freed memory of this process to the system, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run):
    """A function of batches that gives memory back when a task ends.

    A worker process serves the tasks of all stages, one after another; what a stage's largest batch took would else stay
    with it, and add to what the next stages need.
    """
    def wrapped(batches):
        _sparing()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
