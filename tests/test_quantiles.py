"""Exact quantiles equal the sorted definition, whatever path is taken."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.mark.parametrize("limit", [200_000, 50])
def test_skewed_columns(spark, limit):
    df = spark.range(20_000).select(
        F.rand(1).alias("even"), (F.rand(2) ** 20).alias("skewed"),
        F.when(F.rand(3) < 0.4, F.lit(0.5)).otherwise(F.rand(4)).alias("hot"),
        F.floor(F.rand(5) * 10).alias("few"), F.lit(None).cast("double").alias("empty"),
        F.when(F.rand(6) < 0.3, None).otherwise(F.rand(7) * 100 - 50).alias("gaps"),
    ).persist()
    pdf = df.toPandas()
    got = exact_quantiles(df, df.columns, PROBS, distinct_limit=limit)
    assert got["empty"] == [None] * len(PROBS)
    for c in ("even", "skewed", "hot", "few", "gaps"):
        values = pdf[c].dropna().astype(float)
        np.testing.assert_allclose(got[c], np.quantile(values, PROBS), rtol=1e-12, atol=1e-300)
    df.unpersist()


def test_nan_is_not_a_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,), (10.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"] == [2.0]


def test_even_count_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"] == [2.5]


@settings(deadline=None, max_examples=6, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_any_list(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], PROBS, distinct_limit=5)["x"]
    np.testing.assert_allclose(got, np.quantile(values, PROBS), rtol=1e-9, atol=1e-9)


def test_halving_ends_where_sketches_do_not_help(spark, monkeypatch):
    """No sketch rounds at all: brackets are halved by value until few distinct values are left."""
    from millrace.operators import quantiles

    monkeypatch.setattr(quantiles, "SKETCH_ROUNDS", 0)
    df = spark.range(5_000).select((F.rand(3) ** 9).alias("x"), F.when(F.rand(4) < 0.5, -3.0).otherwise(F.rand(5)).alias("hot")).persist()
    got = exact_quantiles(df, ["x", "hot"], PROBS, distinct_limit=20)
    pdf = df.toPandas()
    for c in ("x", "hot"):
        np.testing.assert_allclose(got[c], np.quantile(pdf[c], PROBS), rtol=1e-12, atol=1e-300)
    df.unpersist()


@pytest.mark.parametrize("limit", [200_000, 30])
def test_medians_without_a_fold(spark, monkeypatch, limit):
    """Of all folds but one, from one count of values, with and without a bracket; skewed folds make the search go fold by fold."""
    from millrace.operators import quantiles

    monkeypatch.setattr(quantiles, "DISTINCT_LIMIT", limit)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(3_000):
        f = int(rng.integers(0, 4))
        rows.append((f, None if i % 7 == 0 else float(rng.normal()), int(rng.integers(0, 5)), float(rng.normal(50 * f, 1)), float("nan") if f else float(i), None))
    df = spark.createDataFrame(rows, "fold int, a double, b int, c double, d double, e double").repartition(3)
    columns = ["a", "b", "c", "d", "e"]
    held = {c: {f: [float(r[1 + i]) for r in rows if r[0] == f and r[1 + i] is not None and r[1 + i] == r[1 + i]] for f in range(4)} for i, c in enumerate(columns)}
    counts = {c: {f: len(v) for f, v in by_fold.items()} for c, by_fold in held.items()}
    distinct = {c: len({x for v in by_fold.values() for x in v}) for c, by_fold in held.items()}
    got = quantiles.quantiles_without_fold(df, columns, 0.5, counts, distinct)
    assert set(got) == {(f, c) for f in range(4) for c in columns}
    for (f, c), value in got.items():
        rest = [x for g, v in held[c].items() if g != f for x in v]
        assert value == (pytest.approx(np.median(rest), abs=1e-12) if rest else None), (f, c)
