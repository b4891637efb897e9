"""Mean silhouette of one or several assignments, exact Euclidean or squared.

The Euclidean mean needs the distance between every two distinct points. Equal points are
collapsed to one weighted point, the points are hashed into blocks, and each pair of blocks is one
task-sized group: it holds two blocks, computes their distances in chunks and emits
one row of per-cluster distance sums per point. Distances are shared by all assignments, each
pair of blocks is computed once for both directions, and no pair of points is ever a row.
The work is quadratic in distinct points, so it is done only where ``method="euclidean"`` is named. The
default at every size is ``"squared"``, which needs only cluster moments; the two are different statistics and never mixed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.functions.partials import added

# the grouped function travels with its code, so executors need only numpy and pandas
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# a task holds two blocks; larger blocks mean fewer copies of each point in the shuffle
SMALLEST_BLOCK, LARGEST_BLOCK, BLOCKS_WANTED = 1_024, 16_384, 16
CHUNK = 128
CANCELLED = 1e-4  # of the squared lengths: below, a squared distance by products keeps fewer than some eleven digits
METHODS = ("squared", "euclidean")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices.

    Squares come from one matrix product of the rows less a common point; where little is left of the squared lengths, digits have been cancelled, and those pairs are
    done again by differences."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    shift = b.mean(0)
    x, y = a - shift, b - shift
    lengths = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :]
    total = x @ y.T
    total *= -2.0
    total += lengths
    lengths *= CANCELLED
    left, right = np.nonzero(~(total > lengths))  # numbers that are not finite too
    if len(left) > total.size // 4:
        return _by_differences(a, b)
    for s in range(0, len(left), CHUNK * CHUNK):
        i, j = left[s : s + CHUNK * CHUNK], right[s : s + CHUNK * CHUNK]
        total[i, j] = ((a[i] - b[j]) ** 2).sum(1)
    return np.sqrt(total, out=total)


def _by_differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        step = a[:, j, None] - b[None, :, j]
        total += step * step
    return np.sqrt(total, out=total)


def _sums_by_cluster(d: int, labels: list[np.ndarray], width: int):
    """The per-group function: distance sums of each point to every cluster of each assignment."""
    offsets = np.cumsum([0] + [len(x) for x in labels])

    def indicator(pdf: pd.DataFrame) -> np.ndarray:
        w = np.zeros((len(pdf), width))
        weight = pdf["w"].to_numpy(dtype=float)
        for i in range(len(labels)):
            w[np.arange(len(pdf)), offsets[i] + pdf[f"c{i}"].to_numpy()] += weight
        return w

    def block_pair(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        left = pdf[pdf["b"] == lo]
        right = left if lo == hi else pdf[pdf["b"] == hi]
        x, y = (np.stack(side["x"].to_numpy()) if len(side) else np.zeros((0, d)) for side in (left, right))
        of_left, of_right = indicator(left), indicator(right)
        left_sums, right_sums = np.zeros((len(x), width)), np.zeros((len(y), width))
        for s in range(0, len(x), CHUNK):
            dist = distances(x[s : s + CHUNK], y)
            left_sums[s : s + CHUNK] = dist @ of_right
            if lo != hi:
                right_sums += dist.T @ of_left[s : s + CHUNK]
        keep = ["h1", "h2", "w", *[f"c{i}" for i in range(len(labels))]]
        out = [left[keep].assign(sums=list(left_sums))]
        if lo != hi:
            out.append(right[keep].assign(sums=list(right_sums)))
        return pd.concat(out, ignore_index=True)

    return block_pair


def _points(df: DataFrame, features: Sequence[str], clusters: Sequence[str]) -> DataFrame:
    """Distinct (features, assignments) with their number of copies."""
    return df.groupBy(*[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                      *[col(c).alias(f"c{i}") for i, c in enumerate(clusters)]).agg(F.count(F.lit(1)).alias("w"))


def euclidean_silhouettes(
    df: DataFrame, features: Sequence[str], clusters: Sequence[str], points_per_block: int | None = None
) -> dict[str, float | None]:
    """Mean silhouette per assignment column; singletons count 0; one cluster gives None."""
    points = _points(df, features, clusters).persist()
    try:
        n_points = points.count()
        sizes = []
        for i in range(len(clusters)):
            rows = points.groupBy(f"c{i}").agg(F.sum("w").alias("n")).orderBy(f"c{i}").collect()
            sizes.append([(r[f"c{i}"], r["n"]) for r in rows])
        width = sum(len(s) for s in sizes)
        size = points_per_block or min(LARGEST_BLOCK, max(SMALLEST_BLOCK, n_points // BLOCKS_WANTED))
        blocks = max(1, -(-n_points // size))
        xs = [F.col(f"x{i}") for i in range(len(features))]
        cs = [F.col(f"c{i}") for i in range(len(clusters))]
        coded = []
        for i, s in enumerate(sizes):
            code = F.lit(None).cast("int")
            for j, (value, _) in enumerate(s):
                code = F.when(F.col(f"c{i}").eqNullSafe(F.lit(value)), F.lit(j)).otherwise(code)
            coded.append(code.alias(f"c{i}"))
        # two hashes identify a distinct point without numbering the rows
        identity = [F.xxhash64(*xs, *cs).alias("h1"), F.xxhash64(F.lit(1), *xs, *cs).alias("h2")]
        placed = points.select(*identity, "w", *coded, F.array(*xs).alias("x")).withColumn(
            "b", F.pmod("h1", F.lit(blocks)).cast("int")
        )
        paired = placed.select(
            "*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
        ).select("h1", "h2", "w", *[f"c{i}" for i in range(len(clusters))], "x", "b",
                 F.least("b", "other").alias("lo"), F.greatest("b", "other").alias("hi"))
        labels = [np.arange(len(s)) for s in sizes]
        codes = ", ".join(f"c{i} int" for i in range(len(clusters)))
        sums = paired.groupBy("lo", "hi").applyInPandas(
            _sums_by_cluster(len(features), labels, width),
            f"h1 bigint, h2 bigint, w bigint, {codes}, sums array<double>",
        )
        ids = ["h1", "h2", "w", *[f"c{i}" for i in range(len(clusters))]]
        totals = sums.groupBy(*ids).agg(*[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)])
        values = totals.agg(*[
            (F.sum(_value(i, sizes) * F.col("w")) / F.sum("w")).alias(f"m{i}") for i in range(len(clusters))
        ]).first()
    finally:
        points.unpersist()
    return {c: (values[f"m{i}"] if len(sizes[i]) > 1 else None) for i, c in enumerate(clusters)}


def _value(i: int, sizes: list[list[tuple]]) -> Column:
    """(b - a) / max(a, b) of a point for assignment ``i``, from its distance sums."""
    start = sum(len(s) for s in sizes[:i])
    own = F.col(f"c{i}")
    a, others, alone = F.lit(None).cast("double"), [], F.lit(False)
    for j, (_, n) in enumerate(sizes[i]):
        total, mine = F.col(f"s{start + j}"), own == j
        a = F.when(mine, total / max(n - 1, 1)).otherwise(a)
        others.append(F.when(~mine, total / n))
        if n == 1:
            alone = alone | mine
    b = F.least(*others) if len(others) > 1 else F.lit(None).cast("double")
    larger = F.greatest(a, b)
    return F.when(alone | (larger == 0), 0.0).otherwise((b - a) / larger)


def squared_silhouette(df: DataFrame, vector: str, cluster: str) -> float:
    """Spark's linear-time silhouette on squared distances."""
    scorer = ClusteringEvaluator(featuresCol=vector, predictionCol=cluster, metricName="silhouette",
                                 distanceMeasure="squaredEuclidean")
    return scorer.evaluate(df)


def squared_silhouettes(df: DataFrame, features: Sequence[str], assignments: dict[int, str], moments: Sequence) -> dict[int, float]:
    """Mean silhouette on squared distances of every k, in one pass over the rows, which stay where they are; ``assignments`` names the column of each k.

    The mean squared distance from a point to the points of a cluster is the squared distance to its mean plus its variance, so the
    moments of the clusters (one row per k and cluster, already on the driver) are all that is needed. A k with one cluster is left out."""
    d, lists = len(features), {}
    for r in moments:
        lists.setdefault(r["k"], []).append((r["cluster"], r["n"], float(sum(r[f"v{i}"] for i in range(d))), [float(r[f"m{i}"]) for i in range(d)]))
    ks = [k for k, every in lists.items() if len(every) > 1]
    if not ks:
        return {}
    if any(c is None for k in ks for c, *_ in lists[k]):
        raise ValueError("a silhouette needs rows with clusters")
    known = [[np.array(part) for part in zip(*sorted(lists[k]))] for k in ks]

    def step(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        xs = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:d]]
        whole = np.logical_and.reduce([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns[:d]])
        sums, rows = np.zeros((len(ks), 2)), np.arange(len(batch))
        for i, (names, sizes, variances, means) in enumerate(known):
            place = np.searchsorted(names, batch.column(d + i).to_numpy(zero_copy_only=False))
            apart = sum((x[:, None] - means[None, :, j]) ** 2 for j, x in enumerate(xs)) + variances
            n = sizes[place]
            a = apart[rows, place] * n / np.maximum(n - 1, 1)
            apart[rows, place] = np.inf
            b = apart.min(1)
            larger = np.maximum(a, b)
            flat = (n == 1) | (larger == 0)
            value = np.where(flat, 0.0, (b - a) / np.where(flat, 1.0, larger))
            # rows with missing features have none, but that of a cluster's only row is 0
            counted = whole | (n == 1)
            sums[i] = value[counted].sum(), counted.sum()
        yield sums

    columns = [*[col(f).cast("double") for f in features], *[col(assignments[k]).cast("int").alias(f"c{k}") for k in ks]]
    totals = added(df.select(*columns), step, (len(ks), 2))
    return {k: float(s / n) for k, (s, n) in zip(ks, totals) if n}


def check_method(method: str) -> str:
    if method not in METHODS:
        raise ValueError(f"unknown silhouette method: {method}")
    return method
