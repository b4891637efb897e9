"""Arrays that tasks add up and the driver gets the sum of."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Sums of more partitions than this are added up in two steps, so that the driver gets the root of their number.
DIRECT = 64


def added(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[np.ndarray]], shape: tuple[int, ...], partitions: int | None = None) -> np.ndarray:
    """Sum of the arrays of 64-bit floats that `step` makes of the record batches of `df`, all of the same shape."""

    def gather(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for part in parts:
            total += part
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (np.frombuffer(v, np.float64).reshape(shape) for b in batches for v in b.column(0).to_pylist())

    parts = df.mapInArrow(lambda batches: gather(p for b in batches for p in step(b)), "part binary")
    partitions = df.rdd.getNumPartitions() if partitions is None else partitions
    if partitions > DIRECT:
        parts = parts.repartition(math.isqrt(partitions)).mapInArrow(lambda batches: gather(read(batches)), "part binary")
    return sum((np.frombuffer(r["part"], np.float64).reshape(shape) for r in parts.collect()), np.zeros(shape))
