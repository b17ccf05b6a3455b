"""Tables of a fixed size that every task fills in part and Spark adds up."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 14
SCHEMA = "chunk int, part binary"


def parts_of(table: np.ndarray, packed: bool = False) -> Iterator[tuple[int, bytes]]:
    """Non-zero chunks of a task's table; ``packed`` ones are compressed, which pays where most values are small."""
    for k in range(0, len(table), CHUNK):
        part = table[k : k + CHUNK]
        if part.any():
            yield k // CHUNK, zlib.compress(part.tobytes(), 1) if packed else part.tobytes()


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of counts; an error where one does not fit."""
    total = a + b
    if (total < a).any():
        raise OverflowError(f"a count does not fit in {total.dtype}")
    return total


def combined(parts: DataFrame, kind: type, add: Callable[[np.ndarray, np.ndarray], np.ndarray], packed: bool = False) -> DataFrame:
    """One row per chunk: the combination of all tasks' rows for it, streamed, never held together.  The result is never packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(0, kind)
        for batch in batches:
            for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("part"), strict=True):
                values = np.frombuffer(zlib.decompress(part.as_py()) if packed else part.as_py(), dtype=kind)
                if chunk != now:
                    if now is not None:
                        yield chunk_row(now, total)
                    now, total = chunk, values
                else:
                    total = add(total, values)
        if now is not None:
            yield chunk_row(now, total)

    return parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, SCHEMA)


def chunk_row(chunk: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([values.tobytes()], pa.binary())], names=["chunk", "part"])


def collect_table(parts: DataFrame, size: int, kind: type, add: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add, packed: bool = False) -> np.ndarray:
    """The combined table on the driver.  ``size`` is a parameter, so it does not grow with the data."""
    out = np.zeros(size, dtype=kind)
    # one job for all chunks: an iterator would run a job for each partition
    for row in combined(parts, kind, add, packed).collect():
        values = np.frombuffer(bytes(row["part"]), dtype=kind)
        out[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(values)] = values
    return out
