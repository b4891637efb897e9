"""Embedding whitening: leading principal components by Jacobi-Davidson on products that Spark makes, never a covariance matrix.

1. A row counts if its vector is neither null nor holds a null or non-finite entry. Entries become whole numbers x = floor(steps * c). A vector shorter than the
   longest one is filled up with zeros, an empty one too, so that every remaining row has a result.
2. The fit list is each distinct x vector once, so a hot vector weighs no more than a rare one; it is written to the shared folder. One pass gives its size n and
   its exact sums S, which define the centre S / n.
3. `jacobi_davidson.leading` asks for products with the covariance. A product is one pass over the fit list: each task centres its vectors, multiplies them with the few
   columns it was sent, and adds up as many columns again. The driver sees dimension x columns, never a vector.
4. A last pass over all remaining rows projects them; nothing is shuffled for it.

Arithmetic on x is exact: 64-bit where n * x fits, Python's integers where it doesn't. Components whose eigenvalue is zero to rounding can't be whitened and are left out, so a
table of fewer distinct vectors or dimensions has fewer rows; an empty table has none. Null ids and repeated ids keep one result for each row. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.jacobi_davidson import leading
from millrace.llm.shared import discard, written

COMPONENTS, STEPS = 4, 256
#: Products of more partitions than this are added up in two steps. Vectors are centred so many bytes at a time.
DIRECT, CHUNK = 64, 1 << 22
SCHEMA = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def usable(vector: str) -> Column:
    """Neither null nor with an entry that is null, NaN or infinite."""
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & finite


def quantised(rows: DataFrame, size: int, steps: int) -> DataFrame:
    """(id, x) from (id, vector): x as `size` 64-bit numbers in a binary cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(1).cast(pa.large_list(pa.float64()))
            lengths = np.diff(vectors.offsets.to_numpy())
            x = np.zeros((len(lengths), size), np.int64)
            bound = float(np.nextafter(2.0**63, 0))
            x[np.arange(size) < lengths[:, None]] = np.clip(np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * steps), -bound, bound).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([row.tobytes() for row in x], pa.binary())], ["id", "x"])

    return rows.mapInArrow(run, f"id {rows.schema[0].dataType.simpleString()}, x binary")


def _arrays(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The vectors of a binary column, some rows at a time."""
    width, at = 8 * size, column.offset
    data = np.frombuffer(column.buffers()[2], np.int64)[at * size : (at + len(column)) * size].reshape(-1, size) if len(column) else np.zeros((0, size), np.int64)
    for a in range(0, len(data), max(1, CHUNK // width)):
        yield data[a : a + max(1, CHUNK // width)]


def _total(x: np.ndarray) -> list[int]:
    """Sums of the columns, exact."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    return x.sum(0).tolist() if most * len(x) < 1 << 62 else x.astype(object).sum(0).tolist()


@dataclass(frozen=True)
class Centre:
    """Size and sums of the fit list."""

    n: int
    sums: tuple[int, ...]

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in 64 bits where that is exact."""
        most = (float(np.abs(x.astype(np.float64)).max(initial=0)) + 1) * self.n
        if 2 * most < 1 << 62 and max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.apart(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 of each row; null where that is no 64-bit number."""
        d = self.apart(x)
        if d.dtype == object or float(np.abs(d.astype(np.float64)).max(initial=0)) ** 2 * d.shape[1] >= 1 << 62:
            d = d.astype(object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(1).tolist()]


@dataclass(frozen=True)
class Whitening:
    """Components as columns of `vectors`, their eigenvalues, what share of the trace each explains, and how far whitened fit vectors are from uncorrelated."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def centre(fit: DataFrame, size: int) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for b in batches:
            for x in _arrays(b.column(0), size):
                n, sums = n + len(x), [s + t for s, t in zip(sums, _total(x), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(s) for s in sums]], pa.list_(pa.string()))], ["n", "sums"])

    parts = fit.mapInArrow(run, "n bigint, sums array<string>").select("n", F.posexplode("sums").alias("k", "s"))
    # sums of a task fit 38 digits, as they are at most its rows times 2^63
    rows = parts.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by_place = {r.k: r for r in rows}
    return Centre(by_place[0].n if rows else 0, tuple(int(by_place[k].s) for k in range(size)) if rows else ())


def _added(fit: DataFrame, shape: tuple[int, int], step, partitions: int) -> np.ndarray:
    """Sum over all tasks of the arrays that `step` makes of a binary column, in 64-bit floats."""

    def gather(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for part in of(b.column(0)):
                total += part
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    read = lambda column: (np.frombuffer(v, np.float64).reshape(shape) for v in column.to_pylist())
    parts = fit.mapInArrow(lambda batches: gather(batches, step), "part binary")
    if partitions > DIRECT:
        parts = parts.repartition(math.isqrt(partitions)).mapInArrow(lambda batches: gather(batches, read), "part binary")
    return sum((np.frombuffer(r.part, np.float64).reshape(shape) for r in parts.collect()), np.zeros(shape))


def learn(fit: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """From the fit list: a written table of one binary column."""
    around, partitions = centre(fit, size), fit.rdd.getNumPartitions()

    def product(columns: np.ndarray) -> np.ndarray:
        def step(column: pa.Array) -> Iterator[np.ndarray]:
            for x in _arrays(column, size):
                c = around.centred(x)
                yield c.T @ (c @ columns)

        return _added(fit, columns.shape, step, partitions) / around.n

    def squares(column: pa.Array) -> Iterator[np.ndarray]:
        for x in _arrays(column, size):
            c = around.centred(x)
            yield np.array([[(c * c).sum()]])

    trace = float(_added(fit, (1, 1), squares, partitions)[0, 0]) / around.n if around.n else 0.0
    values, vectors = leading(product, size, components, trace) if trace > 0 else (np.zeros(0), np.zeros((size, 0)))
    real = values > 1e-12 * trace
    values, vectors = values[real], vectors[:, real]
    k = len(values)

    def products(column: pa.Array) -> Iterator[np.ndarray]:
        for x in _arrays(column, size):
            w = around.centred(x) @ vectors / np.sqrt(values)
            yield w.T @ w

    error = float(np.abs(_added(fit, (k, k), products, partitions) / around.n - np.eye(k)).max()) if k else 0.0
    return Whitening(around, values, vectors, values / trace if k else np.zeros(0), error)


def transform(rows: DataFrame, model: Whitening, id_col: str) -> DataFrame:
    """For each row of (id, x) and each component: id and the columns of `SCHEMA`."""
    size, k = model.vectors.shape
    basis = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for x in _arrays(b.column(1), size) if k else ():
                m = len(x)
                ids = b.column(0).slice(at, m).take(pa.array(np.repeat(np.arange(m), k)))
                deviation = pa.array(model.centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                columns = [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.centre.n)), deviation,
                    pa.array((model.centre.centred(x) @ basis).ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays([ids, *columns], [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
                at += m

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, {SCHEMA}")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, steps: int = STEPS) -> DataFrame:
    """Learn from all vectors and project them all: see `transform`."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable("vector"))
    size = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    if not size:  # no row, or none with an entry
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {rows.schema[0].dataType.simpleString()}, {SCHEMA}")
    x = quantised(rows, size, steps)
    fit = written(x.select("x").distinct())
    model = learn(fit, size, components)
    discard(fit)
    return transform(x, model, id_col)
