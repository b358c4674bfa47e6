"""Columns of numbers, dealt out by hash in runs: a row holds all that some texts send to one place, as bytes.

Shuffling a row for each n-gram costs Spark more than all that is done with it. Here a row is a run of them, and numpy works
on all runs that arrived at one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def places(spark: SparkSession) -> int:
    """Twice the shuffle partitions, so that a place's runs take little memory in a worker."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of equal shares of the hashes' lower halves."""
    return ((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(buckets)) >> np.uint64(32)


def upper_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The same of their upper halves, which rise with the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def runs(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    """``values`` as binary rows; row i has the values bounds[i] to bounds[i + 1]."""
    offsets = (bounds * values.dtype.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def values(column: pa.Array, dtype: str) -> np.ndarray:
    """The values of all rows of ``runs``, one after the other."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, dtype)
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(dtype) if at[-1] > at[0] else np.zeros(0, dtype)


def gathered(batches: Iterator[pa.RecordBatch], dtypes: dict[str, str]) -> dict[str, np.ndarray]:
    """The values of the named columns of all batches."""
    found = {c: [] for c in dtypes}
    for batch in batches:
        for c, dtype in dtypes.items():
            found[c].append(values(batch.column(c), dtype).copy())
    return {c: np.concatenate(x) if x else np.zeros(0, dtypes[c]) for c, x in found.items()}


def deal(rows: DataFrame, count: int, place: str = "place") -> DataFrame:
    """``rows`` in ``count`` partitions, each in the one that it names."""
    return rows.repartitionById(count, rows[place])
