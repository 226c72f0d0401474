"""Small helpers shared by the operators that work on Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import SparkSession

SLICE_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_KEPT: dict[str, Any] = {}


def bound_batches(spark: SparkSession) -> None:
    """Cuts the batches that Spark sends to Python workers by bytes also, unless the session says
    how. Both ends of the pipe hold whole batches, and 10 000 rows of text have no bound."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(2 * SLICE_BYTES))


def keep(name: str, build: Callable[[], Any]) -> Any:
    """What `build` gave the first time in this worker, until a task lets it go."""
    if name not in _KEPT:
        _KEPT[name] = build()
    return _KEPT[name]


def let_go() -> None:
    """Frees what earlier tasks kept in this worker: Spark uses a worker again for any operator,
    and what one keeps would stay beside the next one's data."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()  # tables and their caches refer to each other


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows of about `most` bytes, one row at least, so that what a task
    holds follows the longest row and not the number of rows in a batch."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
