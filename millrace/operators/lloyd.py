"""K-means for every k and every start at once.

All fits share their passes over the rows. A pass sends the centres of all fits that still move to the tasks as one matrix; each task returns a count, a sum of points and
a cost for every (k, start, cluster), and the driver gets the sums of those. Fits whose centres have come to rest drop out. So ten starts of nine k take as many passes
as the slowest one of them, `max_iter` at most.

Starts are k-means++: each new centre is a point drawn with a chance in proportion to its squared distance from the centres so far. Every point draws an exponential of that rate and the
first one wins, so one pass draws a centre for all starts. Draws come from a hash of the point, the start and the round, so they depend neither on partitions nor on the machine; equal points
draw alike and count as one. The first k centres of a start are its start for that k. A table with fewer distinct points than k has as many clusters as it has points.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, quoted
from millrace.functions.partials import added

#: Rows of a block.
BLOCK = 4_096
#: A fit has come to rest when the squares of its centres' moves add up to no more than this share of the features' mean variance.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Centres:
    """A fitted clustering: centres of the scaled features, its cost on the training rows and the iterations it took."""

    features: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]
    cost: float
    iterations: int
    start: int

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name that Spark's model has
        return [np.array(c) for c in self.centres]

    def stage(self, out: str = "cluster") -> SQLTransformer:
        """Adds the index of the nearest centre, the first on ties, from the columns of the features."""
        squares = [" + ".join(f"power({quoted(f)} - {v!r}D, 2)" for f, v in zip(self.features, c)) for c in self.centres]
        nearest = "CAST(array_position(_squares, array_min(_squares)) - 1 AS INT)"
        return SQLTransformer(statement=f"SELECT * EXCEPT (_squares), {nearest} AS {quoted(out)} FROM (SELECT *, array({', '.join(squares)}) AS _squares FROM __THIS__)")


def blocks(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(x): the features of some thousand rows as 64-bit floats in one binary cell. Rows with a missing feature are an error."""
    width = len(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if any(c.null_count for c in b.columns):
                raise ValueError("k-means needs rows without missing features")
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) + 0.0 if len(b) else np.zeros((0, width))
            for a in range(0, len(x), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x[a : a + BLOCK]).tobytes()], pa.binary())], ["x"])

    return df.select(*[col(f).cast("double") for f in features]).mapInArrow(pack, "x binary")


def nearest_of_each(df: DataFrame, features: Sequence[str], fits: Mapping[str, Sequence[Sequence[float]]]) -> DataFrame:
    """The features as doubles and for each fit a column with the index of the nearest centre, the first on ties, as `Centres.stage` gives it."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            near = [sum((x - np.array(centres)[:, j, None]) ** 2 for j, x in enumerate(xs)).argmin(0) for centres in fits.values()]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(n, pa.int32()) for n in near]], names)

    names = [*features, *fits]
    schema = ", ".join([*[f"{quoted(f)} double" for f in features], *[f"{quoted(c)} int" for c in fits]])
    return df.select(*[col(f).cast("double").alias(f) for f in features]).mapInArrow(assign, schema)


def _points(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for b in batches:
        for cell in b.column(0).to_pylist():
            yield np.frombuffer(cell, np.float64).reshape(-1, width)


def _drawn(x: np.ndarray, start: int, turn: int, seed: int) -> np.ndarray:
    """An exponential of rate 1 for each point, from its hash."""
    h = np.full(len(x), np.uint64((seed * 1_000_003 + start * 1_009 + turn + 1) % (1 << 64)))
    for j in range(x.shape[1]):
        h = (h ^ np.ascontiguousarray(x[:, j]).view(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
    return -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))


def starts(packed: DataFrame, width: int, n_init: int, most: int, seed: int) -> list[np.ndarray]:
    """For each start its first `most` centres, fewer if there are fewer distinct points."""
    chosen: list[list[tuple[float, ...]]] = [[] for _ in range(n_init)]
    schema = "start int, race double, x array<double>"

    for turn in range(most):
        now = [np.array(c) for c in chosen]

        def draw(batches: Iterator[pa.RecordBatch], now=now, turn=turn) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, list[float]]] = {}
            for x in _points(batches, width):
                for s, centres in enumerate(now):
                    rate = np.ones(len(x))
                    if len(centres):
                        rate = np.min([((x - c) ** 2).sum(1) for c in centres], 0)
                    with np.errstate(divide="ignore"):
                        race = np.where(rate > 0, _drawn(x, s, turn, seed) / rate, np.inf)
                    i = int(race.argmin()) if len(race) else -1
                    # equal races are equal points, or as good as impossible
                    if i >= 0 and math.isfinite(race[i]) and (s not in best or race[i] < best[s][0]):
                        best[s] = (float(race[i]), x[i].tolist())
            rows = [(s, *v) for s, v in sorted(best.items())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.float64(), pa.list_(pa.float64())))], ["start", "race", "x"])

        winners = packed.mapInArrow(draw, schema).groupBy("start").agg(F.min(F.struct("race", "x")).alias("first")).collect()
        for r in winners:
            if len(chosen[r["start"]]) == turn:
                chosen[r["start"]].append(tuple(r["first"]["x"]))
    return [np.array(c).reshape(-1, width) for c in chosen]


def _sums(packed: DataFrame, width: int, fits: Sequence[np.ndarray], partitions: int, costs: bool = False) -> list[np.ndarray]:
    """For each fit a row (count, cost if asked for, sum of points) per cluster, points going to their nearest centre, the first on ties."""
    all_centres = np.vstack(fits)
    ends = np.cumsum([len(c) for c in fits])
    first = ends - [len(c) for c in fits]
    half = (all_centres**2).sum(1) / 2
    shape = (len(all_centres), width + 2)

    def step(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for x in _points([batch], width):
            part, across = np.zeros(shape), np.ascontiguousarray(x.T)
            ones = np.column_stack([np.ones(len(x)), x])
            for a, z in zip(first, ends):
                apart = half[a:z, None] - all_centres[a:z] @ across  # a row for each centre: whole rows are compared at once
                hit = apart == apart.min(0)
                if np.count_nonzero(hit) != len(x):
                    hit = np.arange(z - a)[:, None] == apart.argmin(0)
                sums = hit.astype(np.float64) @ ones
                part[a:z, 0], part[a:z, 2:] = sums[:, 0], sums[:, 1:]
                if costs:
                    near = hit.argmax(0)
                    part[a:z, 1] = np.bincount(near, weights=((x - all_centres[a + near]) ** 2).sum(1), minlength=z - a)
            yield part

    total = added(packed, step, shape, partitions)
    return [total[a:z] for a, z in zip(first, ends)]


def iterate(packed: DataFrame, width: int, fits: Sequence[np.ndarray], max_iter: int, tolerance: float) -> list[tuple[np.ndarray, float, int]]:
    """(centres, cost, iterations) of each fit, from the given centres; the cost is that of the returned centres. `tolerance`: of the squares of the moves, added up."""
    partitions = packed.rdd.getNumPartitions()
    centres, took = [c.copy() for c in fits], [0] * len(fits)
    moving = [i for i, c in enumerate(fits) if len(c)]
    for _ in range(max_iter):
        if not moving:
            break
        sums = _sums(packed, width, [centres[i] for i in moving], partitions)
        still = []
        for i, s in zip(moving, sums):
            full = s[:, 0] > 0  # a centre without points stays where it is
            new = np.where(full[:, None], s[:, 2:] / np.where(full, s[:, 0], 1)[:, None], centres[i])
            if ((new - centres[i]) ** 2).sum() > tolerance:
                still.append(i)
            centres[i], took[i] = new, took[i] + 1
        moving = still
    real = [i for i, c in enumerate(centres) if len(c)]
    costs = dict.fromkeys(range(len(fits)), 0.0)
    if real:
        costs |= {i: float(s[:, 1].sum()) for i, s in zip(real, _sums(packed, width, [centres[i] for i in real], partitions, costs=True))}
    return [(c, costs[i], took[i]) for i, c in enumerate(centres)]


def fit_range(df: DataFrame, features: Sequence[str], ks: Sequence[int], n_init: int = 10, max_iter: int = 300, seed: int = 42) -> dict[int, Centres]:
    """For each k the fit of lowest cost, of equal ones the first start."""
    features = tuple(features)
    if not features or min(ks, default=1) < 1:
        raise ValueError("k-means needs features and a positive number of clusters")
    variances = df.agg(*[F.var_pop(col(f)).alias(f"v{i}") for i, f in enumerate(features)]).first()
    tolerance = TOLERANCE * sum(v or 0.0 for v in variances) / len(features)
    packed = blocks(df, features).persist()
    try:
        first = starts(packed, len(features), n_init, max(ks, default=0), seed)
        plan = [(k, s) for k in ks for s in range(n_init)]
        found = iterate(packed, len(features), [first[s][:k] for k, s in plan], max_iter, tolerance)
    finally:
        packed.unpersist()
    out: dict[int, Centres] = {}
    for (k, s), (centres, cost, took) in zip(plan, found):
        if not len(centres):
            raise ValueError("k-means needs rows")
        if k not in out or cost < out[k].cost:
            out[k] = Centres(features, tuple(map(tuple, centres.tolist())), cost, took, s)
    return out
