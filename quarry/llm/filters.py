"""Arrays that all tasks of a job fill together, and Bloom filters made so.

Each task fills an array of its own and sends it in slices; slices meet by
number, a reducer adds up (or joins) the ones it is dealt as they arrive, and
the driver receives each slice once. What it receives is the array's size,
whatever the number of tasks, and no reducer holds more than that.

Bloom filters only spare work: a row that a filter lets through by chance is
dropped by the join that follows, and no wanted row is ever lost. Their size is
bounded by MOST_BITS; of more keys they let more rows through, at last all, and
the join that follows is then a plain join by shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28
LEAST_BITS = 1 << 16
SLICES = 256
SLICE_COLUMNS = "slice int, data binary"


def sliced(array: np.ndarray) -> pa.RecordBatch:
    """A task's array as one row per slice that is not all zero."""
    parts = array.reshape(SLICES, -1)
    some = np.flatnonzero(parts.any(1))
    packed = [zstandard.compress(parts[i].tobytes(), 1) for i in some]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary())], ["slice", "data"])


def merged(
    slices: DataFrame,
    size: int,
    dtype: np.dtype,
    add: Callable[[np.ndarray, np.ndarray], np.ndarray],
    finish: Callable[[np.ndarray], np.ndarray] = lambda x: x,
) -> np.ndarray:
    """The array of `size` values that the tasks' slices (slice, data) make
    together, `finish` applied to each whole slice."""
    width = size // SLICES

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(zstandard.decompress(data.as_py()), dtype)
                have[number] = add(have[number], part) if number in have else part
        for number, part in have.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([finish(part).tobytes()], pa.binary())], ["slice", "data"]
            )

    nothing = finish(np.zeros(width, dtype))
    out = np.tile(nothing, (SLICES, 1))
    for row in slices.repartition("slice").mapInArrow(meet, SLICE_COLUMNS).collect():
        out[row.slice] = np.frombuffer(row.data, nothing.dtype)
    return out.ravel()


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mask = np.uint64(bits - 1)
    return (keys >> np.uint64(32)) & mask, (keys * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)) & mask


def contains(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), dtype=bool)
    for place in _places(np.ascontiguousarray(keys), 8 * len(bitmap)):
        found &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
    return found


def bloom(df: DataFrame, key: str) -> Broadcast:
    """A broadcast bitmap of the 64-bit keys in column `key`."""
    n = df.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(16 * max(n, 1)))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(bits >> 3, dtype=np.uint8)
        for batch in batches:
            for place in _places(batch.column(0).to_numpy(), bits):
                np.bitwise_or.at(bitmap, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        yield sliced(bitmap)

    slices = df.select(F.col(key).cast("long")).mapInArrow(build, SLICE_COLUMNS)
    return df.sparkSession.sparkContext.broadcast(merged(slices, bits >> 3, np.dtype(np.uint8), np.bitwise_or))


def maybe_in(sent: Broadcast, key: Column) -> Column:
    """Whether the filter lets the 64-bit key pass."""

    @F.arrow_udf("boolean")
    def passes(keys: pa.Array) -> pa.Array:
        return pa.array(contains(sent.value, keys.to_numpy()))

    return passes(key)
