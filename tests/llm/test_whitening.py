"""Whitening by Jacobi-Davidson, against numpy's eigenvectors of the covariance."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening
from millrace.llm.jacobi_davidson import leading

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, x binary, vector string, n int, component int, deviation int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, b"x", "v", 3, 4, 5) for i, v in vectors], SCHEMA).repartition(4)


def plain(vectors, components=4, steps=256):
    """(rows of id and x, n, sums, eigenvalues, eigenvectors, trace) without Spark."""
    good = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max((len(v) for _, v in good), default=0)
    rows = [(i, tuple(math.floor(steps * float(np.float32(c))) for c in v) + (0,) * (size - len(v))) for i, v in good]
    fit = np.array(sorted({x for _, x in rows}), np.int64).reshape(-1, size)
    n, sums = len(fit), fit.sum(0)
    c = (n * fit - sums) / max(n, 1)
    values, basis = np.linalg.eigh(c.T @ c / max(n, 1)) if size else (np.zeros(0), np.zeros((0, 0)))
    return rows, n, sums, values[::-1][:components], basis[:, ::-1][:, :components], values.sum()


def check(found, vectors, components=4):
    rows, n, sums, values, basis, trace = plain(vectors, components)
    assert len(found) == len(rows) * len(values)
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in found) == sorted((i is None, i or 0, k + 1) for i, _ in rows for k in range(len(values)))
    by_id = {i: np.array(x, np.int64) for i, x in rows}
    for r in found:
        k, apart = r.component - 1, n * by_id[r.vec_id] - sums
        assert r.n == n and r.deviation == int((apart * apart).sum())
        assert abs(r.explained - values[k] / trace) < 1e-10 and 0 <= r.identity_error < 1e-8
    for k in range(len(values)):
        own = [r for r in found if r.component == k + 1]
        expected = np.array([(n * by_id[r.vec_id] - sums) / n @ basis[:, k] / math.sqrt(values[k]) for r in own])
        got = np.array([r.whitened for r in own])
        assert np.abs(got * np.sign(got @ expected) - expected).max() < 1e-7


def vectors(seed, rows, size=12):
    r = np.random.default_rng(seed)
    return [(i, [float(c) for c in (r.standard_normal(size) * np.linspace(0.3, 1.1, size)).astype(np.float32)]) for i in range(rows)]


def test_whitened_rows(spark):
    found = vectors(3, 300)
    hot = found[5][1]
    found += [(1000 + i, hot) for i in range(150)] + [(None, found[7][1]), (2000, None), (2001, [0.1, None] + [0.0] * 10), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11)]
    check(whitening.whiten(table(spark, found)).collect(), found)


def test_many_partitions_give_the_same(spark, monkeypatch):
    found = vectors(4, 200, 6)
    monkeypatch.setattr(whitening, "DIRECT", 0)
    monkeypatch.setattr(whitening, "CHUNK", 100)
    check(whitening.whiten(table(spark, found)).collect(), found)


def test_shorter_vectors_are_filled_up(spark):
    found = vectors(5, 60, 5) + [(900, [0.5, 0.25]), (901, [])]
    check(whitening.whiten(table(spark, found)).collect(), found)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, []), (2, [])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]])
def test_nothing_to_whiten(spark, rows):
    out = whitening.whiten(table(spark, rows))
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_dimensions_than_components(spark):
    r = random.Random(1)
    found = [(i, [r.random(), 2 * r.random()]) for i in range(40)]
    check(whitening.whiten(table(spark, found)).collect(), found)
    flat = [(i, [r.random(), 0.5]) for i in range(40)]
    assert {x.component for x in whitening.whiten(table(spark, flat)).select("component").distinct().collect()} == {1}


def test_exact_where_64_bits_are_too_few(spark):
    found = [(i, [float(i) * 1e12, 1.0 + i]) for i in range(20)]
    rows, n, sums, *_ = plain(found)
    wide = {i: sum((n * a - int(s)) ** 2 for a, s in zip(x, sums.tolist(), strict=True)) for i, x in rows}
    out = whitening.whiten(table(spark, found)).where(F.col("component") == 1).collect()
    assert {r.vec_id: r.deviation for r in out} == {i: v if v < 2**63 else None for i, v in wide.items()}
    assert any(r.deviation is None for r in out)


@pytest.mark.parametrize("spectrum", [[3.0], [1.0] * 3, [1.0, 0, 0, 0, 0], [0.0] * 6, [1 / (1 + i) ** 2 for i in range(200)], [5.0] * 5 + [1.0] * 95, [1 + 1e-3 * i for i in range(150)]])
def test_eigenpairs(spectrum):
    size = len(spectrum)
    basis, _ = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    matrix = (basis * np.array(spectrum)) @ basis.T
    matrix = (matrix + matrix.T) / 2
    values, vectors_ = leading(lambda y: matrix @ y, size, 4, sum(spectrum))
    assert np.abs(values - np.sort(spectrum)[::-1][:4]).max() < 1e-12 * max(1, max(spectrum))
    assert np.abs(vectors_.T @ vectors_ - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors_ - vectors_ * values) < 1e-10 * max(1, max(spectrum))
